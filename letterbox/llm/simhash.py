"""Near duplicates by SimHash: fingerprints, pigeonhole blocks, Hamming check, components.

A NULL or empty text has no shingle and fingerprint zero; such rows form a
group like any other. Equal fingerprints always link, also of repeated rows.
NULL ids are passed over when the smallest id of a component is taken; of rows that
share it the smallest hash of the text stays. A bit set in exactly half the shingles
is 0. A very long text is read whole by one task. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import common
from .common import ID, ROW_HASH, TEXT
from .components import components

#: Members of a bucket compared within one task; a larger bucket is cut into tiles, compared pair by pair.
TILE = 2048
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Each bit is that of the majority of the shingles' XXH64; ties give 0. ASCII letters are lowered."""
    found = text.lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > shingle:
        starts, ends = starts[: 1 - shingle or None], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    hashes = np.array([of(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist())], "<u8")
    places = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + 256 * np.arange(8)
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BYTE_BITS
    return int(np.packbits(counts.ravel() * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        texts = batch.column(TEXT).cast(pa.large_binary()).to_pylist()
        marks = np.fromiter((fingerprint(t, shingle, seed) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(ID), batch.column(ROW_HASH), pa.array(marks.view(np.int64))], [ID, ROW_HASH, "lb_mark"]
        )


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", *, shingle: int = 4, seed: int = 42
) -> DataFrame:
    """``lb_id``, ``lb_row_hash``, ``lb_mark`` (the fingerprint as a signed number) of every row."""
    return (
        common.ids_and_texts(docs, id_column, text_column)
        .select(ID, F.xxhash64(TEXT).alias(ROW_HASH), TEXT)
        .mapInArrow(partial(_fingerprints, shingle=shingle, seed=seed), f"{ID} long, {ROW_HASH} long, lb_mark long")
    )


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of the ``blocks - distance`` blocks that a pair within the distance shares, for every choice."""
    ends = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:])]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def links(marks: DataFrame, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """``a``, ``b``: links between distinct fingerprints that connect all within the distance.

    The 64 bits are cut into blocks; two fingerprints that differ in at most
    ``distance`` bits agree in at least ``blocks - distance`` of them, so each
    choice of that many blocks is a table to join on, and no pair is missed.
    More blocks make more rows and fewer chance partners: 7 are exact at any
    size and cheap up to some tens of millions of fingerprints; the default
    takes 8 beyond that. Buckets of two are checked as they are. Larger ones are
    compared in a task, beyond ``TILE`` members in tiles, and return a shallow
    tree over the members linked instead of all their pairs.
    """
    number = marks.count()
    blocks = blocks or (distance + 3 if number <= 1 << 25 else distance + 4)
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(distance, blocks)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("lb_mark").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    rows = marks.select("lb_mark", F.explode(keys).alias("lb_block"))
    buckets = common.saved(
        rows.groupBy("lb_block")
        .agg(F.count("*").alias("lb_size"), F.min("lb_mark").alias("a"), F.max("lb_mark").alias("b"))
        .filter("lb_size > 1"),
        "buckets",
        number * len(masks) // 2,
    )
    pairs = (
        buckets.filter("lb_size = 2")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )
    large = buckets.filter("lb_size > 2").select(
        "lb_block", F.ceil(F.col("lb_size") / TILE).cast("int").alias("lb_tiles")
    )
    hits = common.with_hit(rows, common.bitmap(large, "lb_block"), "lb_block", "lb_hit").filter("lb_hit")
    tile = F.pmod(F.xxhash64("lb_mark"), F.col("lb_tiles")).cast("int")
    members = (
        hits.join(large, "lb_block")
        .withColumn("lb_own", tile)
        .withColumn("lb_other", F.explode(F.sequence(F.lit(0), F.col("lb_tiles") - 1)))
        .groupBy("lb_block", F.least("lb_own", "lb_other").alias("i"), F.greatest("lb_own", "lb_other").alias("j"))
        .agg(F.collect_list("lb_mark").alias("lb_marks"))
        .select("lb_marks")
    )
    trees = members.mapInArrow(partial(_trees, distance=distance), "a long, b long")
    return pairs.unionByName(trees).distinct()


def _trees(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(np.zeros(0, np.int64),) * 2]
        for marks in batch.column(0):
            found += linked(np.unique(marks.values.to_numpy(zero_copy_only=False)), distance)
        a, b = (np.concatenate(x) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def linked(marks: np.ndarray, distance: int, fan: int = 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each set of marks connected within the distance, the edges of a tree of ``fan`` children a node."""
    left = marks.view(np.uint64)
    while len(left) > 1:
        reached, left, at = left[:1], left[1:], 0
        while at < len(reached) and len(left):
            near = np.bitwise_count(left ^ reached[at]) <= distance
            reached, left, at = np.concatenate([reached, left[near]]), left[~near], at + 1
        if len(reached) > 1:
            child = np.arange(1, len(reached))
            yield reached[(child - 1) // fan].view(np.int64), reached[child].view(np.int64)


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    shingle: int = 4,
    distance: int = 4,
    seed: int = 42,
    blocks: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``lb_id``, ``lb_row_hash``, ``fingerprint``
    (16 hex digits), ``component_id`` (the smallest id reachable) and ``kept``
    (whether the row has the component's smallest id and hash).
    """
    rows = common.saved(
        fingerprints(docs, id_column, text_column, shingle=shingle, seed=seed), "fingerprints"
    )
    least = F.min(F.struct(F.col(ID).isNull().alias("none"), F.col(ID).alias("id"), F.col(ROW_HASH).alias("hash")))
    size = rows.count()
    marks = common.saved(
        rows.groupBy("lb_mark").agg(least.alias("lb_first"), F.count("*").alias("lb_size")), "marks", size
    )
    found = components(links(marks.select("lb_mark"), distance, blocks))
    linked_marks = marks.join(found.withColumnRenamed("node", "lb_mark"), "lb_mark", "left").withColumn(
        "component", F.coalesce("component", "lb_mark")
    )
    linked_marks = common.saved(linked_marks, "marks", size)
    sizes = linked_marks.groupBy("component").agg(
        F.min("lb_first").alias("lb_root"), F.count("*").alias("lb_members")
    )
    rooted = common.attach(
        linked_marks.select("lb_mark", "lb_size", "component"),
        common.saved(sizes, "roots", size),
        "component",
        "lb_members",
    ).select("lb_mark", "lb_size", "lb_root")
    return common.attach(rows, common.saved(rooted, "marks", size), "lb_mark", "lb_size").select(
        ID,
        ROW_HASH,
        F.lower(F.lpad(F.hex("lb_mark"), 16, "0")).alias("fingerprint"),
        F.col("lb_root.id").alias("component_id"),
        (F.col(ID).eqNullSafe(F.col("lb_root.id")) & (F.col(ROW_HASH) == F.col("lb_root.hash"))).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings
) -> DataFrame:
    """``docs`` with one row of each component, all columns kept; rows that repeat id and text count once."""
    found = near_duplicates(docs, id_column, text_column, **settings)
    dropped = (
        found.groupBy(ID, ROW_HASH)
        .agg(F.max("kept").alias("lb_kept"), F.count("*").alias("lb_times"))
        .filter("NOT lb_kept OR lb_times > 1")
        .select(ID, ROW_HASH, F.col("lb_kept").alias("lb_keep_one"))
    )
    return common.without(docs, common.saved(dropped, "near-dropped"), id_column, text_column)
