"""Best-fit packing of documents' tokens, after Martello and Toth's dominance reduction.

A document is its token ids and an end id. Documents longer than a sequence are
cut into full pieces and a last one. Which pieces share a sequence depends on
their lengths only, so the instance is the number of pieces of each length: a
list as long as a sequence at most, whatever the corpus. It is packed on the
driver, in patterns with multiplicities; the pieces, ranked within their length,
then find their places by themselves.

A NULL or empty text is its end id alone. Rows that repeat are packed each. NULL
ids are carried through. A very long text is tokenized whole by one task and cut
only then. Pieces of equal length are interchangeable; their ids and checksums
order them. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common
from .common import ID, TEXT
from .token_counts import encoder

#: Rows of one length are ranked in groups of about this many.
RANK_GROUP = 50_000
#: At least so many groups a length, so that one length may hold a third of all rows.
RANK_GROUPS = 64

Pattern = tuple[tuple[int, int], ...]  # (length, how often) in order of placing


# The packing of lengths, on counts -----------------------------------------------------


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], Counter]:
    """Bins that an optimal packing may as well have, and what is left.

    For the largest piece ``j`` not yet looked at, with room ``r`` beside it:

    - nothing fits: ``{j}`` is a bin;
    - the largest ``l`` that fits fills the room, or no two pieces fit
      together, or no two that fit are larger than ``l``: ``{j, l}``
      dominates every other set with ``j``;
    - no three fit, and the best partner ``b`` of ``l`` is as large as the
      smaller one of any two that fit: ``{j, l, b}`` dominates.

    Otherwise ``j`` stays in the instance. Each step uses up a length or passes
    one, so the steps are bounded by the lengths, not by the pieces.
    """
    left = Counter({n: c for n, c in counts.items() if c})
    sizes = sorted(left)
    fixed: list[tuple[Pattern, int]] = []

    def take(*items: int) -> None:
        """As many such bins as there are pieces for."""
        need = Counter(items)
        bins = min(left[n] // k for n, k in need.items())
        fixed.append((tuple(sorted(need.items(), reverse=True)), bins))
        for n, k in need.items():
            left[n] -= bins * k
            if not left[n]:
                del left[n]
                sizes.pop(bisect_left(sizes, n))

    def largest(room: int, *taken: int) -> int:
        """The largest piece within the room besides those taken; 0 for none."""
        at = bisect_right(sizes, room) - 1
        while at >= 0 and left[sizes[at]] <= taken.count(sizes[at]):
            at -= 1
        return sizes[at] if at >= 0 else 0

    def smallest(n: int, j: int) -> int:
        """The total of the ``n`` smallest pieces besides one ``j``; beyond any room if there are fewer."""
        total = 0
        for size in sizes:
            have = min(n, left[size] - (size == j))
            total, n = total + have * size, n - have
            if not n:
                return total
        return capacity + 1

    bound = capacity + 1
    while sizes and (at := bisect_left(sizes, bound) - 1) >= 0:
        j = sizes[at]
        room = capacity - j
        l = largest(room, j)  # noqa: E741
        if not l:
            take(j)
        elif l == room or smallest(2, j) > room:
            take(j, l)
        elif smallest(3, j) > room:
            b = largest(room - l, j, l)
            k = largest(room // 2, j)  # the smaller one of two that fit is no larger
            if _best_pair(sizes, left, room, j) <= l:
                take(j, l)
            elif b and k <= b:
                take(j, l, b)
            else:
                bound = j
        else:
            bound = j
    return fixed, left


def _best_pair(sizes: list[int], left: Counter, room: int, j: int) -> int:
    """The largest total of two pieces within the room, besides one ``j``."""
    best, low, high = 0, 0, bisect_right(sizes, room) - 1
    have = lambda size: left[size] - (size == j)
    while low <= high:
        a, b = sizes[low], sizes[high]
        if a + b > room or not have(b):
            high -= 1
        elif not have(a) or (low == high and have(a) < 2):
            low += 1
        else:
            best, low = max(best, a + b), low + 1
    return best


def best_fit(counts: Counter, capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit, longest first, on counts: each piece goes to the fullest bin with room.

    Bins with the same content are one entry. Each length opens or splits a few
    entries, so their number is bounded by the lengths too.
    """
    open_: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)  # by the room left
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, bins: int) -> None:
        if bins:
            if not open_[room]:
                insort(rooms, room)
            open_[room].append((pattern, bins))

    for size in sorted(counts, reverse=True):
        number = counts[size]
        while number:
            at = bisect_left(rooms, size)
            room = rooms[at] if at < len(rooms) else capacity
            each = room // size
            if at < len(rooms):
                pattern, bins = open_[room].pop()
                if not open_[room]:
                    rooms.pop(at)
            else:
                pattern, bins = (), -(-number // each)
            filled = min(bins, number // each)
            put(room - each * size, (*pattern, (size, each)), filled)
            number -= filled * each
            if filled < bins and number:  # fewer pieces than fit: one bin takes them
                put(room - number * size, (*pattern, (size, number)), 1)
                number, filled = 0, filled + 1
            if pattern:
                put(room, pattern, bins - filled)
    return [entry for entries in open_.values() for entry in entries]


def pack_lengths(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Patterns of bins with how many there are of each; every piece is in one."""
    fixed, left = reduce(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For pieces by length and rank: from which rank on they are in which bins, at which offset.

    Sorted by ``length`` and ``rank``; a piece of rank ``r`` in an entry is in
    bin ``first + (r - rank) // each`` at ``offset + (r - rank) % each * length``.
    """
    ranks: Counter = Counter()
    rows, first = [], 0
    for pattern, bins in patterns:
        offset = 0
        for length, each in pattern:
            rows.append((length, ranks[length], first, each, offset))
            ranks[length] += bins * each
            offset += each * length
        first += bins
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first", "each", "offset"), table.T))


# The pieces ----------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int, keep_ids: bool):
    for batch in common.slices(batches):
        ids, offsets = encoder(path).encode(batch.column(TEXT))
        sizes = np.diff(offsets)
        text = np.arange(len(sizes))
        closed = np.full(len(ids) + len(sizes), end_id, "<u4")
        closed[np.arange(len(ids)) + np.repeat(text, sizes)] = ids
        begin, sizes = offsets[:-1] + text, sizes + 1
        number = -(-sizes // capacity)
        of = np.repeat(text, number)
        piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
        start = piece * capacity
        length = np.minimum(sizes[of] - start, capacity)
        at = begin[of] + start
        view = memoryview(closed).cast("B")
        check = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
        columns = [
            batch.column(ID).take(pa.array(of)),
            pa.array(piece.astype(np.int32)),
            pa.array(start),
            pa.array(length),
            pa.array(check, pa.int64()),
        ]
        names = [ID, "piece", "start", "length", "ids_crc32"]
        if keep_ids:  # the pieces of all texts in order are the ids in order
            ends = np.concatenate([[0], np.cumsum(length)])
            columns.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(closed.astype(np.int32))))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(columns, names)


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    keep_ids: bool = False,
) -> DataFrame:
    """``lb_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    schema = f"{ID} long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    return common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        partial(_pieces, path=path, capacity=capacity, end_id=end_id, keep_ids=keep_ids), schema
    )


def _placed(batches: Iterator[pa.RecordBatch], table: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    shift = 1 << 45  # ranks stay below
    keys = table["length"] * shift + table["rank"]
    for batch in batches:
        length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "lb_rank"))
        entry = np.searchsorted(keys, length * shift + rank, "right") - 1
        beyond = rank - table["rank"][entry]
        each = table["each"][entry]
        columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "lb_rank"]
        yield pa.RecordBatch.from_arrays(
            [
                *columns,
                pa.array(table["first"][entry] + beyond // each),
                pa.array(table["offset"][entry] + beyond % each * length),
            ],
            [n for n in batch.schema.names if n != "lb_rank"] + ["sequence_id", "offset"],
        )


def pack(cut: DataFrame, capacity: int = 4096) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``cut`` needs ``length``, 1 to ``capacity``.

    A piece's rank within its length comes from counts of (length, group) and
    a row number within the group, so no group grows with the corpus.
    """
    cut = common.saved(cut, "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = places(pack_lengths(counts, capacity))
    groups = max(RANK_GROUPS, max(counts.values(), default=0) // RANK_GROUP)
    key = [c for c in (ID, "piece", "start", "ids_crc32") if c in cut.columns] or cut.columns
    grouped = cut.withColumn("lb_group", F.pmod(F.xxhash64(*key), F.lit(groups)).cast("int"))
    before = (
        grouped.groupBy("length", "lb_group")
        .agg(F.count("*").alias("n"))
        .withColumn("lb_before", F.sum("n").over(Window.partitionBy("length").orderBy("lb_group")) - F.col("n"))
        .drop("n")
    )
    number = F.row_number().over(Window.partitionBy("length", "lb_group").orderBy(*key)) - 1
    ranked = (
        grouped.join(before, ["length", "lb_group"])
        .withColumn("lb_rank", F.col("lb_before") + number)
        .select(*cut.columns, "lb_rank")
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(partial(_placed, table=table), f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and its token ``ids`` in order, of pieces packed with their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
