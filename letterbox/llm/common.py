"""Row keys, joins that stand hot keys, and the byte view of Arrow texts.

What every operator here shares on odd input: a NULL text counts as empty, a
NULL id is a value like any other (``min`` passes over it), rows may repeat,
tables may be empty, and extra columns, whatever their names, are never read:
operators first cut their input down to the internal names below.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import new_folder

ID, TEXT, ROW_HASH = "lb_id", "lb_text", "lb_row_hash"

#: A group with more than this share of the rows is hot; so there are at most as many hot groups.
HOT_GROUPS = 1000
#: Rows of a file of narrow rows, if the table is that large.
FILE_ROWS = 100_000
#: Bits of a membership bitmap: 1 MB, whatever the input. A fuller bitmap lets more rows through.
BITMAP_BITS = 1 << 23


def column(name: str) -> Column:
    """A top-level column, also if its name has dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_text(name: str = "text") -> Column:
    return F.coalesce(column(name).cast("string"), F.lit(""))


def ids_and_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    return df.select(column(id_column).cast("long").alias(ID), whole_text(text_column).alias(TEXT))


def saved(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """Written to the cluster's shared folder and read again: survives lost executors.

    ``rows`` bounds the number of narrow rows; with it, files are not smaller
    than ``FILE_ROWS`` however many partitions a shuffle has.
    """
    path = new_folder(df.sparkSession, label)
    df = df if rows is None else df.coalesce(1 + rows // FILE_ROWS)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Each row with the columns of its group; ``size`` is the group's number of rows.

    Groups with over a thousandth of all rows number under a thousand, so they
    are broadcast; their rows are not shuffled. All others go by the key, where
    none is large. Both inputs are read twice: save them first.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.filter(F.col(size) > F.lit(total // HOT_GROUPS))
    cold = groups.filter(F.col(size) <= F.lit(total // HOT_GROUPS))
    if total < HOT_GROUPS:  # every group is hot, and they are few
        return rows.join(F.broadcast(hot), key)
    return rows.join(F.broadcast(hot), key).unionByName(
        rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    )


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """Which hashes occur, as at most ``BITMAP_BITS`` bits in rows of 4 KB."""
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)) + 1
    return keys.groupBy(F.bitmap_bucket_number(place).alias("lb_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("lb_bits")
    )


def with_hit(rows: DataFrame, bits: DataFrame, key: str, hit: str) -> DataFrame:
    """Adds whether the key may be in the bitmap; never False for a key that is."""
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS)) + 1
    position = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col("lb_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = F.getbit(byte, (position % 8).cast("int")) == 1
    joined = rows.withColumn("lb_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(bits), "lb_bucket", "left")
    return joined.withColumn(hit, F.coalesce(found, F.lit(False))).drop("lb_bucket", "lb_bits")


def without(docs: DataFrame, dropped: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` less the rows whose id and text hash are in ``dropped``.

    ``dropped`` has ``lb_id``, ``lb_row_hash`` and ``lb_keep_one``: where that
    is True, one of the rows that repeat id and text stays. Rows that the
    bitmap of dropped keys rules out are passed on where they lie; only the
    others are shuffled, by id and text hash.
    """
    names = docs.columns
    keyed = docs.select(
        F.struct(*[column(c) for c in names]).alias("lb_row"),
        _id_key(column(id_column).cast("long")).alias("lb_id_key"),
        F.xxhash64(whole_text(text_column)).alias(ROW_HASH),
    ).withColumn("lb_key", F.xxhash64("lb_id_key", ROW_HASH))
    keys = dropped.select(_id_key(F.col(ID)).alias("lb_id_key"), ROW_HASH, "lb_keep_one")
    bits = bitmap(keys.select(F.xxhash64("lb_id_key", ROW_HASH).alias("lb_key")), "lb_key")
    marked = with_hit(keyed, bits, "lb_key", "lb_hit")
    clear = marked.filter(~F.col("lb_hit")).select("lb_row")
    number = F.row_number().over(Window.partitionBy("lb_id_key", ROW_HASH).orderBy(F.lit(0)))
    doubtful = marked.filter("lb_hit").join(keys, ["lb_id_key", ROW_HASH], "left")
    one = doubtful.filter("lb_keep_one").withColumn("lb_number", number).filter("lb_number = 1").select("lb_row")
    kept = doubtful.filter(F.col("lb_keep_one").isNull()).select("lb_row")
    return clear.unionByName(kept).unionByName(one).select(
        *[F.col("lb_row").getField(c).alias(c) for c in names]
    )


def _id_key(value: Column) -> Column:
    """A NULL id joins as the largest number."""
    return F.coalesce(value, F.lit(9223372036854775807))


def held_out(id_column: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a NULL id counts as empty text."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == fold


def smallest_hashes(rows: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows whose ids have the smallest hashes; fewer if there are no more.

    Rows beyond a hash that the count tells are dropped first, so no task gets
    ``most`` rows of each other one.
    """
    total = rows.count()
    share = (most + 8 * most**0.5 + 50) / max(1, total)
    if share < 1:
        rows = rows.filter(F.xxhash64(ID) <= F.lit(int(share * (1 << 64)) - (1 << 63)))
    return rows.orderBy(F.xxhash64(ID), ID).limit(most)


# Arrow batches as bytes ----------------------------------------------------------------

#: Bytes of text worked on at once; a longer text is worked on alone.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def slices(batches: Iterator[pa.RecordBatch], text: str = TEXT) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``SLICE_BYTES`` of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = byte_view(batch.column(text))[1][1:].astype(np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + SLICE_BYTES, "right"))
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def byte_view(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each starts (one more: the end)."""
    if texts.null_count:
        texts = texts.fill_null("")
    large = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if large else np.int32)[texts.offset : texts.offset + len(texts) + 1]
    bytes_ = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, none across two texts."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    starts, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[starts] = inside[starts]
    last[ends] = inside[ends]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes are in words (runs of no ASCII white space), and the words' starts and ends."""
    inside = ~_SPACE[data]
    return inside, *runs(inside, offsets)


def per_text(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of the sorted positions lie in each text."""
    return np.diff(np.searchsorted(starts, offsets))


def codes(data: np.ndarray, inside: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each run of ``inside``, equal for equal bytes, and the distinct runs."""
    places = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=places[1:])
    array = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    )
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values of each text."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]

