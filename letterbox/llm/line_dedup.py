"""Lines repeated across documents, by levelled sorted runs of line hashes. DataFrame functions only.

A text is split at ``\\n``; a NULL or empty one is one empty line. A line's key
is the line without ASCII white space at its ends and with A-Z lowered. Keys of
``least_length`` code points or more that ``least_documents`` documents hold
lose their lines, repeats included, in all of them but those with the largest
id. Every row is a document of its own, also one that repeats an id; a NULL id
is smaller than any other, and rows that share the largest id all keep the
line. Ties between equal lines of a document don't matter, as they share their
fate. Very long texts are split like any other, and only the keys of their
lines are shuffled, never by document. A text is shuffled once, if it loses a
line. An empty table gives an empty result; other columns are carried along.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import storage
from ..session import new_folder
from ..sinks.tables import drop_table, quote_name
from . import common
from .common import ID, ROW_HASH, TEXT

KEY, DOCS, LAST = "lb_key", "lb_docs", "lb_last"

# What counts as white space, and the letters that are lowered.
_SPACE = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The folder of a run names the batches it holds and its number of buckets.
_RUN = re.compile(r"run-(\d+)-(\d+)-in-(\d+)$")


@dataclass(frozen=True)
class Run:
    """Line hashes of the batches ``first`` to ``last``, in ``buckets`` files sorted by hash."""

    first: int
    last: int
    buckets: int

    @property
    def batches(self) -> int:
        return self.last - self.first + 1

    @property
    def folder(self) -> str:
        return f"run-{self.first:06d}-{self.last:06d}-in-{self.buckets}"


class LineRuns:
    """Which line hashes were seen: how many documents hold each, and the largest id of these.

    Each batch is one run, bucketed and sorted by hash. Two neighbours of equal
    span are merged into one of the next level, so a hash is rewritten once a
    level and a batch meets few runs, each at least twice the next one's span.
    Runs share their buckets: a batch is shuffled once, to be merged with all of
    them, and merging two runs shuffles nothing. (They are merged by joins, as a
    union of bucketed scans loses track of its buckets in Spark 4.1.)

    The state is the folder. A run counts when it is complete; one within
    another's span has been merged and is passed over. So a batch or a merge
    that broke off is simply done again.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self._tables: dict[Run, str] = {}
        found = self.runs()
        # As many as Spark is told to shuffle into, or as there are already.
        self.buckets = found[0].buckets if found else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(self) -> list[Run]:
        """Complete runs that no other one contains, in order of their batches."""
        named = [_RUN.match(name) for name in storage.children(self.spark, self.path)]
        complete = [
            Run(*map(int, m.groups()))
            for m in named
            if m and storage.exists(self.spark, f"{self.path}/{m.group()}/_SUCCESS")
        ]
        return sorted(
            (r for r in complete if not any(o.first <= r.first and r.last <= o.last and o != r for o in complete)),
            key=lambda r: r.first,
        )

    def add(self, batch: DataFrame, least_documents: int) -> None:
        """A batch of hashes, one row each: ``lb_key``, ``lb_docs``, ``lb_last``.

        What a run already knows for sure is left out: hashes that have their
        ``least_documents`` and no smaller largest id than the batch's. Batches
        that come by falling id, as ``repeated`` sends them, thus leave out all
        settled lines. An id must not come in two batches.
        """
        known = self.runs()
        number = known[-1].last + 1 if known else 0
        fresh = batch.select(KEY, DOCS, LAST).repartition(self.buckets, KEY).alias("b")
        for run in known:
            settled = self._table(run).filter(F.col(DOCS) >= least_documents).alias("r")
            same = (F.col(f"b.{KEY}") == F.col(f"r.{KEY}")) & (
                F.col(f"b.{LAST}").isNull() | (F.col(f"r.{LAST}") >= F.col(f"b.{LAST}"))
            )
            fresh = fresh.join(settled.hint("merge"), same, "left_anti").alias("b")
        self._write(fresh, Run(number, number, self.buckets))
        self._compact()

    def merged(self) -> DataFrame:
        """One row per hash over all runs. Counts are exact below the bound that settles a hash."""
        return self._merge(self.runs())

    def _compact(self) -> None:
        while True:
            newest = self.runs()[-2:]
            if len(newest) < 2 or newest[0].batches != newest[1].batches:
                return
            self._write(self._merge(newest), Run(newest[0].first, newest[1].last, self.buckets))
            for run in newest:
                self._forget(run)
                storage.remove(self.spark, f"{self.path}/{run.folder}")

    def _merge(self, runs: list[Run]) -> DataFrame:
        """The smallest runs first, so that the largest is never shuffled."""
        if not runs:
            return self.spark.createDataFrame([], f"{KEY} binary, {DOCS} long, {LAST} long")
        rows = self._table(runs[-1])
        for run in reversed(runs[:-1]):
            older = self._table(run).hint("merge")
            docs = F.coalesce(f"o.{DOCS}", F.lit(0)) + F.coalesce(f"n.{DOCS}", F.lit(0))
            rows = older.alias("o").join(rows.alias("n"), KEY, "full_outer").select(
                KEY, docs.alias(DOCS), F.greatest(f"o.{LAST}", f"n.{LAST}").alias(LAST)
            )
        return rows

    def _write(self, rows: DataFrame, run: Run) -> None:
        self._forget(run)
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.write.mode("overwrite")
            .option("path", f"{self.path}/{run.folder}")
            .bucketBy(run.buckets, KEY)
            .sortBy(KEY)
            .saveAsTable(name)
        )
        self._tables[run] = name

    def _table(self, run: Run) -> DataFrame:
        """The run as a bucketed table, registered when another session wrote it."""
        if run not in self._tables:
            name = f"line_run_{uuid.uuid4().hex}"
            self.spark.sql(
                f"CREATE TABLE {quote_name(name)} ({KEY} BINARY, {DOCS} BIGINT, {LAST} BIGINT) USING parquet "
                f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {run.buckets} BUCKETS "
                f"LOCATION '{self.path}/{run.folder}'"
            )
            self._tables[run] = name
        return self.spark.table(self._tables[run])

    def _forget(self, run: Run) -> None:
        if run in self._tables:
            drop_table(self.spark, self._tables.pop(run))

    def close(self) -> None:
        """Drops the runs' names from the catalog; the files stay."""
        for run in list(self._tables):
            self._forget(run)


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(text: Column) -> Column:
    return F.transform(lines(text), lambda line: F.btrim(line, F.lit(_SPACE)))


def _lowered(line: Column) -> Column:
    # Text of ASCII alone is lowered as a whole; elsewhere only A-Z.
    return F.when(F.octet_length(line) == F.length(line), F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))


def _hash(key: Column) -> Column:
    return F.unhex(F.md5(key))


def batch_hashes(docs: DataFrame, least_length: int = 20) -> DataFrame:
    """``lb_key``, ``lb_docs``, ``lb_last`` of the lines in rows of ``lb_id``, ``lb_text``, and ``lb_batch`` if they have it.

    A key counts once a row. Tasks add up their rows before the shuffle, so a
    line that a third of the documents hold costs one row a task.
    """
    by = [c for c in ("lb_batch",) if c in docs.columns]
    long = F.filter(_trimmed(F.col(TEXT)), lambda line: F.length(line) >= least_length)
    keys = F.array_distinct(F.transform(long, _lowered))
    found = docs.select(*by, ID, F.explode(keys).alias("lb_line")).select(*by, ID, _hash(F.col("lb_line")).alias(KEY))
    return found.groupBy(*by, KEY).agg(F.count(F.lit(1)).alias(DOCS), F.max(ID).alias(LAST))


def repeated(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    least_length: int = 20,
    least_documents: int = 3,
    batches: int = 4,
    runs: LineRuns | None = None,
) -> DataFrame:
    """``lb_key`` and ``lb_last`` of the lines that ``least_documents`` documents or more hold.

    The texts are read once; their hashes then go into ``runs`` in batches by
    falling id. ``runs`` of earlier calls count along: their documents must be
    others than these.
    """
    spark = docs.sparkSession
    texts = common.ids_and_texts(docs, id_column, text_column)
    low, high = texts.agg(F.min(ID), F.max(ID)).first()
    width = ((high or 0) - (low or 0)) // batches + 1
    place = F.floor((F.lit(float(high or 0)) - F.col(ID).cast("double")) / F.lit(float(width)))
    batch = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(batches - 1), place)), F.lit(batches - 1)).cast("int")
    hashes = batch_hashes(texts.withColumn("lb_batch", batch), least_length)
    path = new_folder(spark, "line-batches")
    hashes.write.partitionBy("lb_batch").parquet(path)
    written = spark.read.schema(hashes.schema).parquet(path)
    if runs is None:
        runs = LineRuns(spark, new_folder(spark, "line-runs"))
    for number in range(batches):
        runs.add(written.filter(F.col("lb_batch") == number), least_documents)
    return common.saved(runs.merged().filter(F.col(DOCS) >= least_documents).select(KEY, LAST), "repeated-lines")


def drop_repeated_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    least_length: int = 20,
    least_documents: int = 3,
    batches: int = 4,
    runs: LineRuns | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``lb_row`` (the document, its text less the
    lines dropped), ``n_lines`` (before), ``n_dropped``.

    A bitmap of the repeated keys picks the lines to look up, and one of the
    documents that lose a line picks the texts to shuffle. Keys held by over a
    thousandth of these lines are broadcast.
    """
    settings = {"least_length": least_length, "least_documents": least_documents}
    known = repeated(docs, id_column, text_column, batches=batches, runs=runs, **settings)
    dropped = common.saved(_dropped(docs, id_column, text_column, known, least_length), "dropped-lines")

    names = docs.columns
    text = common.whole_text(text_column)
    keyed = docs.select(
        F.struct(*[common.column(c) for c in names]).alias("lb_row"),
        text.alias(TEXT),
        common._id_key(common.column(id_column).cast("long")).alias("lb_id_key"),
        F.xxhash64(text).alias(ROW_HASH),
    ).withColumn("lb_document", F.xxhash64("lb_id_key", ROW_HASH))
    places = dropped.select(common._id_key(F.col(ID)).alias("lb_id_key"), ROW_HASH, "lb_places")
    bits = common.bitmap(places.select(F.xxhash64("lb_id_key", ROW_HASH).alias("lb_document")), "lb_document")
    marked = common.with_hit(keyed, bits, "lb_document", "lb_hit")
    clear = marked.filter(~F.col("lb_hit")).select(
        "lb_row", F.size(lines(F.col(TEXT))).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped")
    )
    joined = marked.filter("lb_hit").join(places, ["lb_id_key", ROW_HASH], "left")
    split = joined.withColumn("lb_lines", lines(F.col(TEXT)))
    cut = F.when(F.col("lb_places").isNotNull(), F.array_join(_without("lb_lines", "lb_places"), "\n")).otherwise(
        F.col("lb_row").getField(text_column)
    )
    row = F.struct(*[(cut if c == text_column else F.col("lb_row").getField(c)).alias(c) for c in names])
    return clear.unionByName(
        split.select(
            row.alias("lb_row"),
            F.size("lb_lines").cast("long").alias("n_lines"),
            F.coalesce(F.size("lb_places"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )


def _dropped(
    docs: DataFrame, id_column: str, text_column: str, known: DataFrame, least_length: int
) -> DataFrame:
    """``lb_id``, ``lb_row_hash``, ``lb_places``: where the lines that go stand, from 0, ascending."""
    keys = F.transform(
        _trimmed(F.col(TEXT)), lambda line: F.when(F.length(line) >= least_length, _lowered(line))
    )
    texts = common.ids_and_texts(docs, id_column, text_column)
    found = (
        texts.select(ID, F.xxhash64(TEXT).alias(ROW_HASH), F.posexplode(keys).alias("lb_place", "lb_line"))
        .filter(F.col("lb_line").isNotNull())
        .select(ID, ROW_HASH, "lb_place", _hash(F.col("lb_line")).alias(KEY))
    )
    hits = common.with_hit(found, common.bitmap(known.select(KEY), KEY), KEY, "lb_hit").filter("lb_hit").drop("lb_hit")
    hits = common.saved(hits, "line-hits")
    sizes = hits.groupBy(KEY).agg(F.count(F.lit(1)).alias("lb_size"))
    groups = common.saved(known.join(sizes, KEY), "line-groups")
    return (
        common.attach(hits, groups, KEY, "lb_size")
        .filter(~F.col(ID).eqNullSafe(F.col(LAST)))
        .groupBy(ID, ROW_HASH)
        .agg(F.sort_array(F.collect_set("lb_place")).alias("lb_places"))
    )


def _without(array: str, places: str) -> Column:
    """The array less its elements at the given places, as the slices between them: linear in its size."""
    before = F.concat(F.array(F.lit(-1)), F.col(places))
    after = F.concat(F.col(places), F.array(F.size(array)))
    return F.flatten(
        F.transform(
            F.arrays_zip(before.alias("a"), after.alias("b")),
            lambda gap: F.slice(array, gap["a"] + 2, gap["b"] - gap["a"] - 1),
        )
    )
