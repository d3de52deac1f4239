"""Toxic passages by maximum-scoring segments over token log-odds, calibrated by extreme values.

Tokens are lower-case runs of letters and digits. A token's weight is its
log-odds between toxic and clean labelled texts under an informative Dirichlet
prior (the pooled counts), negative for tokens of clean texts; tokens whose
log-odds are not significant weigh nothing of their own, and a token without a
weight takes that of its first five characters, if they have one. Counts are of
distinct contexts (the tokens before and after), so that copies and endless
repeats count once. Every token besides those of positive weight costs a drift,
so scores wander down on clean text, and one scan finds all maximal segments.
How high a clean text's segments reach follows an extreme-value law; a text's
score is the calibrated surprise of its best one, together with those of its
other significant segments. Law and calibration are set by texts that the
weights they are scored with were not learned from, in three folds.

A NULL or empty text, or one without a token, has no segment and the score of a
text without one. Rows that repeat get equal scores; NULL ids are carried
through; of labels that contradict each other the toxic one counts. Very long
texts are scanned whole. An empty table gives an empty result; without labels of
both kinds no token weighs anything and every score is 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import common
from .common import ID, TEXT, column

#: Labelled documents at most: those with the smallest hash of their id.
MAX_LABELLED = 6000
#: Characters of a token's stem.
STEM = 5
#: What a token without positive weight costs: sixty of them part two passages of two tokens of the least weight.
DRIFT = 0.1
#: Parts of the labelled texts; each is scored with weights learned from the others.
FOLDS = 3
#: The prior's share of the pooled counts.
PRIOR = 0.1
LEAST_LOG_ODDS, LEAST_Z = 2.0, 3.5

_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[65:91] = _TOKEN[97:123] = True
_TOKEN[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Model:
    """Weights of tokens and stems, the extreme-value law's rate and size, and the calibration."""

    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0
    size: float = 1.0
    bias: float = -50.0
    slope: float = 0.0


def tokens(data: np.ndarray, offsets: np.ndarray):
    """Codes of the tokens of all texts, the distinct tokens, and how many each text has."""
    low = _LOWER[data]
    # Latin letters with marks: their capitals are 32 below in the second byte.
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[capital] += 32
    inside = _TOKEN[data]
    starts, ends = common.runs(inside, offsets)
    code, distinct = common.codes(low, inside, starts, ends)
    return code, distinct.cast(pa.large_string()).to_pylist(), common.per_text(starts, offsets)


def segments(at: np.ndarray, weights: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: first token, last token, score.

    ``at`` are the places of the tokens with weight, in order; all others cost
    ``drift``. Linear in the number of tokens with weight: each positive one is
    put on the list of candidates once and merged at most once.
    """
    after = np.cumsum(weights) - drift * (at - np.arange(len(at)))
    found: list[tuple[int, int, float, float]] = []  # first, last, total before, total behind
    up = weights > 0
    for place, weight, right in zip(at[up].tolist(), weights[up].tolist(), after[up].tolist()):
        first, left = place, right - weight
        while True:
            # Candidates that start higher can't be extended by this one.
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j -= 1
            if j < 0 or found[j][3] >= right:
                found.append((first, place, left, right))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def surprise(scores: list[float], n_tokens: int, rate: float, size: float) -> float:
    """How unlikely a clean text's best segment is to score so high, as minus the logarithm, plus the
    excess of every other segment over the score that one such text in a thousand reaches."""
    if not scores:
        return 0.0
    expected = [math.log(size * max(n_tokens, 1)) - rate * s for s in sorted(scores, reverse=True)]
    # -log(1 - exp(-e)) is -log(e) for small e.
    best = math.exp(min(expected[0], 50))
    total = -math.log(-math.expm1(-best)) if best > 1e-9 else -expected[0]
    return total + sum(max(0.0, -e - math.log(1000)) for e in expected[1:])


def scan(model: Model, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
    """The number of tokens of each text and its segments."""
    code, distinct, counts = tokens(data, offsets)
    words, stems = model.words, model.stems
    weight = np.array([words.get(w) or stems.get(w[:STEM], 0.0) for w in distinct] or [0.0])
    weight[weight < 0] -= DRIFT
    weighted = np.flatnonzero(weight[code]) if len(code) else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    first = np.searchsorted(weighted, ends - counts)
    last = np.searchsorted(weighted, ends)
    for n, end, a, b in zip(counts.tolist(), ends.tolist(), first.tolist(), last.tolist()):
        own = weighted[a:b]
        yield n, segments(own - (end - n), weight[code[own]]) if b > a else []


def score_of(model: Model, found: float) -> float:
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, model.bias + model.slope * found))))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each token of each text with a hash of the tokens around it."""
    for batch in common.slices(batches):
        code, distinct, counts = tokens(*common.byte_view(batch.column(TEXT)))
        if not len(code):
            continue
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in distinct], np.uint64)[code]
        first = np.zeros(len(code), bool)
        starts = np.cumsum(counts) - counts
        first[starts[counts > 0]] = True
        before = np.where(first, np.uint64(0), np.roll(hashes, 1))
        behind = np.where(np.roll(first, -1), np.uint64(0), np.roll(hashes, -1))
        around = (before * np.uint64(0x9E3779B97F4A7C15)) ^ (behind * np.uint64(0xC2B2AE3D27D4EB4F))
        label, fold = (
            np.repeat(batch.column(c).to_numpy(zero_copy_only=False), counts) for c in ("lb_label", "lb_fold")
        )
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(distinct, pa.string()).take(pa.array(code)),
                pa.array(around.view(np.int64)),
                pa.array(label),
                pa.array(fold),
            ],
            ["token", "around", "lb_label", "lb_fold"],
        )


Lexicon = dict[str, tuple[float, float]]


def _lexicons(contexts: DataFrame) -> list[Lexicon]:
    """Weight and share of clean contexts of the significant ``feature``s: learned from all folds, then
    from all but each one. The contexts are counted once for all of these."""
    sets = [F.lit(True), *[F.col("lb_fold") != k for k in range(FOLDS)]]
    kinds = contexts.groupBy("feature", "around").agg(
        *[F.max(F.when(of, F.col("lb_label"))).alias(f"toxic{k}") for k, of in enumerate(sets)],
        *[F.min(F.when(of, F.col("lb_label"))).alias(f"least{k}") for k, of in enumerate(sets)],
    )
    number = lambda column: F.coalesce(F.sum(column), F.lit(0)).cast("double")
    counted = kinds.groupBy("feature").agg(
        *[number(F.col(f"toxic{k}")).alias(f"y{k}") for k in range(len(sets))],
        *[number(1 - F.col(f"least{k}")).alias(f"c{k}") for k in range(len(sets))],
    )
    counted = common.saved(counted, "lexicon", 1_000_000)
    totals = counted.agg(*[F.sum(c).alias(c) for c in counted.columns if c != "feature"]).first()
    found = []
    for k in range(len(sets)):
        all_y, all_c = totals[f"y{k}"] or 0.0, totals[f"c{k}"] or 0.0
        if not all_y or not all_c:
            found.append({})
            continue
        odds, z, clean = _log_odds(F.col(f"y{k}"), F.col(f"c{k}"), all_y, all_c)
        rows = (
            counted.select("feature", odds.alias("odds"), z.alias("z"), clean.alias("clean"))
            .filter((F.col("odds") > LEAST_LOG_ODDS) & (F.col("z") > LEAST_Z) | (F.col("z") < -LEAST_Z))
            .collect()
        )
        found.append({r.feature: (r.odds, r.clean) for r in rows})
    return found


def _log_odds(y: Column, c: Column, all_y: float, all_c: float) -> tuple[Column, Column, Column]:
    """Log-odds under the prior, their z-score, and the share of clean contexts."""
    prior = PRIOR * (all_y + all_c)
    a = F.lit(PRIOR) * (y + c)
    odds = F.log((y + a) / (all_y + prior - y - a)) - F.log((c + a) / (all_c + prior - c - a))
    # A feature that the set lacks has no odds and no z.
    spread = F.sqrt(F.try_divide(F.lit(1.0), y + a) + F.try_divide(F.lit(1.0), c + a))
    return odds, F.try_divide(odds, spread), (c + a) / (all_c + prior)


def law(weights: list[tuple[float, float]]) -> float:
    """The rate at which high scores get rarer on clean text: the positive root of E[exp(rate * score)] = 1.

    ``weights`` are the tokens' weights with their share of clean tokens.
    """
    rest = 1 - sum(p for _, p in weights)

    def mean(rate: float) -> float:
        return sum(p * math.exp(min(rate * w, 700)) for w, p in weights) + rest * math.exp(-rate * DRIFT) - 1

    if not weights or sum(p * w for w, p in weights) >= rest * DRIFT:
        return 1.0  # scores don't drift down: no such law
    low, high = 1e-9, 1.0
    while mean(high) < 0 and high < 100:
        low, high = high, 2 * high
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return (low + high) / 2


def calibrate(x: np.ndarray, labels: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Logistic regression of the label on the surprise, by Newton's method."""
    w = np.zeros(2)
    rows = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (p - labels) + ridge * w
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def _model(words: Lexicon, stems: Lexicon) -> Model:
    # A stem's clean share covers its words; words with a stem of weight are part of it.
    shares = [*stems.values(), *[v for w, v in words.items() if w[:STEM] not in stems]]
    return Model({w: o for w, (o, _) in words.items()}, {s: o for s, (o, _) in stems.items()}, law(shares))


def _least(model: Model) -> float:
    """The median positive weight."""
    up = [o for lexicon in (model.words, model.stems) for o in lexicon.values() if o > 0]
    return float(np.median(up)) if up else 0.0


def _found(batches: Iterator[pa.RecordBatch], models: list[Model]) -> Iterator[pa.RecordBatch]:
    """Each row's segments by the model that was not learned from it."""
    for whole in batches:
        for fold, model in enumerate(models):
            part = whole.filter(pa.compute.equal(whole.column("lb_fold"), fold))
            for batch in common.slices(iter([part])):
                counts, scores = [], []
                for n, own in scan(model, *common.byte_view(batch.column(TEXT))):
                    counts.append(n)
                    scores.append([s for _, _, s in own])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lb_label"),
                        batch.column("lb_fold"),
                        pa.array(counts, pa.int64()),
                        pa.array(scores, pa.list_(pa.float64())),
                    ],
                    ["lb_label", "lb_fold", "n", "scores"],
                )


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    usable: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    max_labelled: int = MAX_LABELLED,
) -> Model:
    """Learn from at most ``max_labelled`` rows of ``labels`` that are ``usable``; a bounded, repeatable sample."""
    known = labels.select(column(id_column).cast("long").alias(ID), column(label).cast("int").alias("lb_label"))
    known = known.filter(F.col(ID).isNotNull() & F.col("lb_label").isin(0, 1))
    if usable is not None:
        known = known.filter(usable)
    known = known.groupBy(ID).agg(F.max("lb_label").alias("lb_label"))
    sample = common.smallest_hashes(known, max_labelled)
    rows = common.saved(
        common.ids_and_texts(docs, id_column, text_column)
        .join(F.broadcast(sample), ID)
        .groupBy(ID)
        .agg(F.min(F.struct("lb_label", TEXT)).alias("row"))
        .select(ID, "row.*", F.pmod(F.hash(ID), F.lit(FOLDS)).alias("lb_fold")),
        "labelled",
    )
    contexts = common.saved(
        rows.mapInArrow(_contexts, "token string, around long, lb_label int, lb_fold int").distinct(),
        "contexts",
        1000 * max_labelled,
    )
    words = _lexicons(contexts.withColumnRenamed("token", "feature"))
    stems = _lexicons(
        contexts.filter(F.length("token") >= STEM).select(
            F.substring("token", 1, STEM).alias("feature"), "around", "lb_label", "lb_fold"
        )
    )
    if not any(o > 0 for lexicon in (words[0], stems[0]) for o, _ in lexicon.values()):
        return Model()
    model, *parts = [_model(w, s) for w, s in zip(words, stems)]
    kind = "lb_label int, lb_fold int, n long, scores array<double>"
    seen = rows.mapInArrow(partial(_found, models=parts), kind).collect()
    sizes = [_size(part, [r for r in seen if r.lb_fold == k]) for k, part in enumerate(parts)]
    x = np.array([surprise(r.scores, r.n, parts[r.lb_fold].rate, sizes[r.lb_fold]) for r in seen])
    bias, slope = calibrate(x, np.array([float(r.lb_label) for r in seen]))
    return Model(model.words, model.stems, model.rate, math.exp(np.mean(np.log(sizes))), bias, slope)


def _size(model: Model, seen: list) -> float:
    """The law's size: so that segments of clean texts above the median weight are as many as it says."""
    least = _least(model)
    above = sum(s >= least for r in seen if not r.lb_label for s in r.scores) + 0.5
    among = sum(r.n for r in seen if not r.lb_label) + 1
    return above * math.exp(model.rate * least) / among


def _scored(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    model = model.value
    # A segment counts as significant if one clean text in twenty, of that length, has one so high.
    limit = -math.log(1 - 0.95)
    for batch in common.slices(batches):
        scores, passages = [], []
        for n, own in scan(model, *common.byte_view(batch.column(TEXT))):
            scores.append(score_of(model, surprise([s for _, _, s in own], n, model.rate, model.size)))
            passages.append(
                [
                    {"first": a, "last": b, "score": s}
                    for a, b, s in own
                    if model.rate * s - math.log(model.size * max(n, 1)) >= limit
                ]
            )
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(ID), pa.array(scores, pa.float64()), pa.array(passages, kind)], [ID, "score", "passages"]
        )


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lb_id``, ``score`` (0 to 1) and ``passages`` (first and last token, score) of every row; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        partial(_scored, model=sent),
        f"{ID} long, score double, passages array<struct<first: long, last: long, score: double>>",
    )
