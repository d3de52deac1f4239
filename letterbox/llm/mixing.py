"""Mixing sources to target weights: temperature, bisected exponent, budgeted block permutations.

A source's weight is its token share raised to an exponent and normalised. The
exponent is bisected so that the weights reach a target entropy, or until a
limit on repetition binds. Each source then gets a budget of tokens, spent in
whole passes over its documents and a last pass over a permutation of its
blocks of documents, cut where the budget ends.

A NULL source counts as the source ''. A NULL id counts as empty text. A text
without a word has no tokens and rides along where its place in the permutation
falls. Rows that repeat id and token count share one fate at the cut. A source
without tokens keeps one pass. Very long texts are counted whole and not cut: a
document falls on one side of the budget's end. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import small_rows
from . import common
from .common import column

#: Hexadecimal digits that name a document's block: 4096 blocks a source; twice as many name the sub-block.
BLOCK_DIGITS = 3
#: More sources than this are not held on the driver nor broadcast; their plan is made as a table.
MAX_SOURCES = 100_000
#: The exponent is a multiple of 2 ** -STEPS.
STEPS = 20


@dataclass(frozen=True)
class Mix:
    """What to reach. ``entropy`` is a share of the largest possible, that of equal weights.

    Without ``budget`` the corpus is spent so that no source stays below one
    whole pass: the smallest budget that leaves no document out.
    """

    entropy: float | None = 0.999
    max_passes: float | None = 2.0
    budget: int | None = None
    seed: str = "mix"


def entropy(weights: list[float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights if w > 0)


def tempered(tokens: list[int], exponent: float) -> list[float]:
    """Weights of the sources, from shares raised to the exponent."""
    total = sum(tokens)
    raised = [(n / total) ** exponent if n else 0.0 for n in tokens]
    whole = math.fsum(raised)
    return [r / whole for r in raised]


def budgets(tokens: list[int], weights: list[float], budget: int | None) -> list[float]:
    """Passes over each source."""
    if budget is None:
        # The scale at which the source with the fewest passes has exactly one.
        scale = min((w / n for w, n in zip(weights, tokens) if n), default=1.0)
        return [w / n / scale if n else 1.0 for w, n in zip(weights, tokens)]
    return [budget * w / n if n else 1.0 for w, n in zip(weights, tokens)]


def exponent(tokens: list[int], mix: Mix) -> float:
    """The largest exponent up to 1 that reaches the entropy, raised while a source would pass too often.

    Entropy falls and repetition falls as the exponent grows, so both are
    bisected on the same grid.
    """
    filled = [n for n in tokens if n]
    return _bisected(
        len(filled),
        mix,
        lambda x: entropy(tempered(filled, x)),
        lambda x: max(budgets(filled, tempered(filled, x), mix.budget)),
    )


def _bisected(filled: int, mix: Mix, entropy_at, most_passes) -> float:
    """The exponent, given the number of sources with tokens and what holds at an exponent."""
    if filled < 2:
        return 1.0

    def bisect(reached) -> int:
        """The largest step up to 1 for which ``reached`` holds; it holds below, if anywhere."""
        low, high = 0, 1 << STEPS
        if reached(high):
            return high
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if reached(middle) else (low, middle)
        return low

    grid = 1 << STEPS
    chosen = grid
    if mix.entropy is not None:
        target = mix.entropy * math.log(filled)
        chosen = bisect(lambda k: entropy_at(k / grid) >= target)
    if mix.max_passes is not None:

        def excessive(k: int) -> bool:
            return most_passes(k / grid) > mix.max_passes

        if excessive(chosen):
            chosen = min(bisect(excessive) + 1, grid)
    return chosen / grid


def token_count(text: Column) -> Column:
    """Words of no ASCII white space; any other count of tokens may take its place."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _keys(docs: DataFrame, id_column: str, source_column: str, tokens: Column, seed: str) -> list[Column]:
    """Of a row: source, tokens, and its place in the permutation that cuts the last pass.

    Blocks are named by the first digits of the id's digest; their order is
    that of a digest of seed, source and block. Within a block, documents are
    in the order of their digest.
    """
    source = F.coalesce(column(source_column).cast("string"), F.lit(""))
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(column(id_column).cast("string"), F.lit(""))).cast("binary"))
    block = F.substring(digest, 1, BLOCK_DIGITS)
    order = F.md5(F.concat_ws(":", F.lit(seed), source, block).cast("binary"))
    return [
        source.alias("lb_source"),
        tokens.alias("lb_tokens"),
        # Blocks of a source are told apart by their order, a digest of the block's name.
        F.concat(F.substring(order, 1, 16), digest).alias("lb_place"),
    ]


#: Digits of the place that tell the block; with as many digits more, the sub-block.
_BLOCK = 16 + BLOCK_DIGITS
_SUB_BLOCK = _BLOCK + BLOCK_DIGITS


def plan(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    tokens: Column | None = None,
) -> DataFrame:
    """One row per source: ``source``, ``tokens``, ``share``, ``weight``, ``exponent``,
    ``budget``, ``passes`` (whole ones), ``cut`` (last place of the partial pass, '' for none).

    The cut is found by adding up blocks, then the sub-blocks of the block that
    holds it, then the documents of that sub-block, so that nothing larger than
    a list of 4096 blocks or the documents of one sub-block is in one place.
    """
    rows, sources = _sources(docs, mix, id_column, text_column, source_column, tokens)
    totals = sources.limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"over {MAX_SOURCES} sources: their list would not be small enough to broadcast")
    return _small_plan(rows, totals, mix)


def plan_table(
    docs: DataFrame,
    mix: Mix = Mix(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    tokens: Column | None = None,
) -> DataFrame:
    """As ``plan``, for any number of sources.

    Over ``MAX_SOURCES``, weights and cuts are worked out in Spark, one aggregate
    for each step of the bisection. That plan has the rows of each source as
    ``lb_rows`` also, by which ``passes`` joins it without broadcasting all of it.
    """
    rows, sources = _sources(docs, mix, id_column, text_column, source_column, tokens)
    totals = sources.limit(MAX_SOURCES + 1).collect()
    return _small_plan(rows, totals, mix) if len(totals) <= MAX_SOURCES else _large_plan(rows, sources, mix)


def _sources(docs: DataFrame, mix: Mix, id_column: str, text_column: str, source_column: str, tokens: Column | None):
    """Source, tokens and place of each row, saved; and the tokens of each source."""
    tokens = token_count(common.whole_text(text_column)) if tokens is None else tokens
    rows = common.saved(docs.select(*_keys(docs, id_column, source_column, tokens, mix.seed)), "mixing")
    return rows, rows.groupBy("lb_source").agg(F.sum("lb_tokens").alias("tokens"), F.count(F.lit(1)).alias("lb_rows"))


def _small_plan(rows: DataFrame, totals: list, mix: Mix) -> DataFrame:
    totals.sort(key=lambda r: r.lb_source)
    counts = [r.tokens or 0 for r in totals]
    chosen = exponent(counts, mix)
    weights = tempered(counts, chosen) if any(counts) else [0.0] * len(counts)
    whole = sum(counts) or 1
    plans = []
    for r, n, w, p in zip(totals, counts, weights, budgets(counts, weights, mix.budget)):
        spend = math.floor(p * n)
        passes = spend // n if n else 1
        plans.append(
            {"lb_source": r.lb_source, "tokens": n, "share": n / whole, "weight": w, "exponent": chosen}
            | {"budget": spend, "passes": passes, "before": "", "cut": ""}
            | {"left": spend - passes * n, "open": spend > passes * n}
        )
    for digits in (_BLOCK, _SUB_BLOCK, None):
        plans = _descend(rows, plans, digits)
    return small_rows(rows.sparkSession, [{k: v for k, v in p.items() if k in _PLAN.names} for p in plans], _PLAN)


_PLAN = pa.schema(
    [
        ("lb_source", pa.string()),
        ("tokens", pa.int64()),
        ("share", pa.float64()),
        ("weight", pa.float64()),
        ("exponent", pa.float64()),
        ("budget", pa.int64()),
        ("passes", pa.int64()),
        ("cut", pa.string()),
    ]
)


def _large_plan(rows: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """The plan as a table; only sums over it come to the driver."""
    sources = common.saved(sources.withColumn("tokens", F.coalesce("tokens", F.lit(0))), "mixing")
    # Sources with as many tokens have the same weight.
    sizes = common.saved(sources.filter("tokens > 0").groupBy("tokens").agg(F.count(F.lit(1)).alias("n")), "mixing")
    filled, whole, least, most = sizes.agg(
        F.sum("n"), F.sum(F.col("n") * F.col("tokens")), F.min("tokens"), F.max("tokens")
    ).first()
    filled, whole = filled or 0, whole or 1

    def raised(x: float) -> Column:
        return F.pow(F.col("tokens") / F.lit(whole), F.lit(x))

    def entropy_at(x: float) -> float:
        r = raised(x)
        total, inner = sizes.agg(F.sum(F.col("n") * r), F.sum(F.col("n") * r * F.log(r))).first()
        return math.log(total) - inner / total

    def most_passes(x: float) -> float:
        """Of the smallest source, as passes fall with a source's tokens."""
        if mix.budget is None:
            return (least / whole) ** x / least / ((most / whole) ** x / most)
        return mix.budget * (least / whole) ** x / sizes.agg(F.sum(F.col("n") * raised(x))).first()[0] / least

    chosen = _bisected(filled, mix, entropy_at, most_passes)
    total = sizes.agg(F.sum(F.col("n") * raised(chosen))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, raised(chosen) / F.lit(total)).otherwise(0.0)
    by_token = F.col("weight") / F.col("tokens")
    weighted = common.saved(sources.withColumn("weight", weight), "mixing")
    if mix.budget is None:
        scale = weighted.filter("tokens > 0").agg(F.min(by_token)).first()[0] or 1.0
        passed = by_token / F.lit(scale)
    else:
        passed = F.lit(float(mix.budget)) * F.col("weight") / F.col("tokens")
    spend = F.when(F.col("tokens") > 0, F.floor(passed * F.col("tokens"))).otherwise(0).cast("long")
    plans = (
        weighted.withColumn("share", F.col("tokens") / F.lit(whole))
        .withColumn("exponent", F.lit(chosen))
        .withColumn("budget", spend)
        .withColumn("passes", F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(1).cast("long"))
        .withColumn("left", F.col("budget") - F.col("passes") * F.col("tokens"))
        .withColumn("open", F.col("left") > 0)
        .withColumns({"before": F.lit(""), "cut": F.lit("")})
    )
    plans = common.saved(plans, "mixing")
    for digits in (_BLOCK, _SUB_BLOCK, None):
        state = plans.filter("open").select("lb_source", "lb_rows", "left", "before")
        found = _fitting(common.attach(rows, state, "lb_source", "lb_rows"), digits)
        # "~" sorts behind every digit: the whole part is within the cut.
        whole_part = F.concat("last", F.lit("~" if digits else ""))
        joined = plans.join(found, "lb_source", "left")
        plans = common.saved(
            joined.select(
                "lb_source", "lb_rows", "tokens", "share", "weight", "exponent", "budget", "passes",
                F.coalesce(whole_part, "cut").alias("cut"),
                (F.col("left") - F.coalesce("spent", F.lit(0))).alias("left"),
                F.coalesce("next", F.lit("")).alias("before"),
                F.col("next").isNotNull().alias("open"),
            ),
            "mixing",
        )
    return plans.select(*_PLAN.names, "lb_rows")


def _descend(rows: DataFrame, plans: list[dict], digits: int | None) -> list[dict]:
    """Spend what is left on whole parts in order; go into the part that no longer fits.

    Parts are the places' first ``digits``, or the documents themselves, which
    also carry their token count, so that only true repeats are one part.
    """
    spark = rows.sparkSession
    schema = pa.schema([("lb_source", pa.string()), ("left", pa.int64()), ("before", pa.string())])
    open_ = [p for p in plans if p["open"]]
    if not open_:
        return plans
    state = small_rows(spark, [{n: p[n] for n in schema.names} for p in open_], schema)
    found = {r.lb_source: r for r in _fitting(rows.join(F.broadcast(state), "lb_source"), digits).collect()}
    after = []
    for p in plans:
        r = found.get(p["lb_source"])
        if not p["open"] or r is None:
            after.append(p)
            continue
        # "~" sorts behind every digit: the whole part is within the cut.
        cut = p["cut"] if r.last is None else r.last + ("~" if digits else "")
        after.append(
            p | {"cut": cut, "left": p["left"] - (r.spent or 0), "before": r.next or "", "open": r.next is not None}
        )
    return after


def _fitting(rows: DataFrame, digits: int | None) -> DataFrame:
    """Of each source: the last part that fits into what is ``left``, the tokens up to it, and the next part."""
    part = place(F.col("lb_place"), F.col("lb_tokens"))
    part = F.substring(part, 1, digits) if digits else part
    parts = (
        rows.filter(F.col("lb_place").startswith(F.col("before")))
        .groupBy("lb_source", "left", part.alias("part"))
        .agg(F.sum("lb_tokens").alias("n"))
    )
    order = Window.partitionBy("lb_source").orderBy("part")
    spent = parts.withColumn("spent", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    fits = F.col("spent") <= F.col("left")
    return spent.groupBy("lb_source").agg(
        F.max(F.when(fits, F.col("part"))).alias("last"),
        F.max(F.when(fits, F.col("spent"))).alias("spent"),
        F.min(F.when(~fits, F.col("part"))).alias("next"),
    )


def place(at: Column, tokens: Column) -> Column:
    """A row's place with its token count, in an order that holds for texts."""
    return F.concat(at, F.lpad(tokens.cast("string"), 20, "0"))


def passes(
    docs: DataFrame,
    plans: DataFrame,
    mix: Mix = Mix(),
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    tokens: Column | None = None,
) -> DataFrame:
    """``docs``, one row for each pass a document takes part in, with ``lb_pass`` from 0 and ``lb_place``,
    and its source's ``exponent``, ``weight`` and ``budget``.

    Each row decides by itself from the broadcast plan; nothing is shuffled. Of
    a plan with ``lb_rows``, only sources with many rows are broadcast.
    """
    tokens = token_count(common.whole_text(text_column)) if tokens is None else tokens
    keyed = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("lb_row"),
        *_keys(docs, id_column, source_column, tokens, mix.seed),
    )
    taken = F.col("passes") + (place(F.col("lb_place"), F.col("lb_tokens")) <= F.col("cut")).cast("int")
    of_source = plans.select("lb_source", "passes", "cut", "exponent", "weight", "budget", *_rows_of(plans))
    if _rows_of(plans):
        joined = common.attach(keyed, of_source, "lb_source", "lb_rows")
    else:
        joined = keyed.join(F.broadcast(of_source), "lb_source")
    return (
        joined.withColumn("lb_taken", taken.cast("int"))
        .filter("lb_taken > 0")
        .withColumn("lb_pass", F.explode(F.sequence(F.lit(0), F.col("lb_taken") - 1)))
        .select("lb_row", "lb_source", "lb_tokens", "lb_place", "lb_pass", "exponent", "weight", "budget")
    )


def _rows_of(plans: DataFrame) -> list[str]:
    return [c for c in plans.columns if c == "lb_rows"]


def mixed(docs: DataFrame, mix: Mix = Mix(), **columns) -> DataFrame:
    """``docs`` repeated or cut to the weights, with its own columns."""
    taken = passes(docs, plan_table(docs, mix, **columns), mix, **columns)
    return taken.select(*[F.col("lb_row").getField(c).alias(c) for c in docs.columns])
