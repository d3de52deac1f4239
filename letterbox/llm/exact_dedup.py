"""Exact duplicates by progressive refinement: length, prefix hash, full hash. DataFrame functions only.

Texts are equal when they are after each run of ASCII white space became one
space. Of equal texts the row with the smallest id stays; NULL ids come last;
of rows that repeat id and text one stays, and equal ids with texts that differ
in their white space tie by the text's hash. NULL texts count as empty, and empty
texts equal each other. Very long texts are read whole, by one task each, and never
shuffled. Only the two columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import common
from .common import ID, ROW_HASH, TEXT

#: Characters of the normalised text in the prefix hash.
PREFIX = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, digest_all: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``lb_id``, ``lb_row_hash``, ``keep_id``,
    ``group_size``, ``kept``, ``text_sha256``, ``settled_by``.

    1. One scan takes each text's length and prefix hash. Only these are
       shuffled, as counts; what has no partner there is unique.
    2. A second scan takes the full SHA-256 of the texts whose length and
       prefix are shared, told by a bitmap of bounded size; no text is shuffled.
    3. The hashes are grouped, counts first, and joined back by ``attach``.

    Rows settled by step 1 have no ``text_sha256`` unless ``digest_all``.
    """
    texts = common.ids_and_texts(docs, id_column, text_column).select(
        ID, F.xxhash64(TEXT).alias(ROW_HASH), normalised(F.col(TEXT)).alias("lb_text")
    )
    narrow = texts.select(
        F.octet_length("lb_text").alias("lb_length"), F.xxhash64(F.substring("lb_text", 1, PREFIX)).alias("lb_prefix")
    )
    # Partners need the same length first; within a length, the same prefix.
    shared = narrow.groupBy("lb_length", "lb_prefix").count().filter("count > 1")
    bits = common.bitmap(shared.select(_key().alias("lb_key")), "lb_key")

    scanned = common.with_hit(
        texts.withColumns(
            {
                "lb_length": F.octet_length("lb_text"),
                "lb_prefix": F.xxhash64(F.substring("lb_text", 1, PREFIX)),
            }
        ).withColumn("lb_key", _key()),
        bits,
        "lb_key",
        "lb_hit",
    )
    digest = F.sha2(F.col("lb_text").cast("binary"), 256)
    hashed = common.saved(
        scanned.select(
            ID,
            ROW_HASH,
            "lb_length",
            "lb_hit",
            (digest if digest_all else F.when(F.col("lb_hit"), digest)).alias("text_sha256"),
        ),
        "exact-dedup",
    )
    alone = hashed.filter(~F.col("lb_hit")).select(
        ID,
        ROW_HASH,
        F.col(ID).alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
        F.lit("prefix").alias("settled_by"),
    )
    size = hashed.count()
    # Rows that repeat id and text are counted within their task only: no count exceeds a task's rows.
    rows = common.saved(
        hashed.filter("lb_hit")
        .withColumn("lb_task", F.spark_partition_id())
        .groupBy("text_sha256", "lb_length", ID, ROW_HASH, "lb_task")
        .agg(F.count("*").alias("lb_times")),
        "exact-rows",
        size,
    )
    first = F.min(
        F.struct(
            F.col(ID).isNull().alias("none"),
            F.col(ID).alias("id"),
            F.col(ROW_HASH).alias("hash"),
            F.col("lb_task").alias("task"),
        )
    )
    groups = common.saved(
        rows.groupBy("text_sha256").agg(first.alias("lb_first"), F.sum("lb_times").alias("group_size")),
        "exact-groups",
        size,
    )
    joined = common.attach(rows, groups, "text_sha256", "group_size").withColumn(
        "lb_copy", F.explode(F.sequence(F.lit(1), F.col("lb_times")))
    )
    stays = (
        F.col(ID).eqNullSafe(F.col("lb_first.id"))
        & (F.col(ROW_HASH) == F.col("lb_first.hash"))
        & (F.col("lb_task") == F.col("lb_first.task"))
        & (F.col("lb_copy") == 1)
    )
    grouped = joined.select(
        ID,
        ROW_HASH,
        F.col("lb_first.id").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
        "text_sha256",
        F.lit("full").alias("settled_by"),
    )
    return alone.unionByName(grouped)


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept.

    Only rows whose key may be a dropped one are shuffled with their text.
    """
    decisions = exact_duplicates(docs, id_column, text_column).filter("settled_by = 'full'")
    # A row that repeats id and text is dropped by its key; one copy stays if it is the group's.
    dropped = (
        decisions.groupBy(ID, ROW_HASH)
        .agg(F.max("kept").alias("lb_kept"), F.count("*").alias("lb_times"))
        .filter("NOT lb_kept OR lb_times > 1")
        .select(ID, ROW_HASH, F.col("lb_kept").alias("lb_keep_one"))
    )
    return common.without(docs, common.saved(dropped, "exact-dropped"), id_column, text_column)


def _key() -> Column:
    return F.xxhash64("lb_length", "lb_prefix")
