"""Conversation structure repair: a square-root checkpointed dynamic program over edits of each row.

A conversation's rows, by turn (NULLs first, ties by role, then by the MD5 of
the text), are kept (cost 0), given another role (user or assistant, 2) or
deleted (3, a must for blank and duplicate rows), and empty user or assistant
rows are inserted (2), until the roles' initials read ``(s?(ua)+)?``. A
truncated row that stays costs 1 more. Of the cheapest edits those with the
ASCII-least initials (D, I, K, R) are taken; they also fix each new role.

NULL roles and texts count as one space, so such texts are blank; an empty role
has no initial and fits nowhere. Rows that repeat turn, role and text are
duplicates of the first. Rows with a NULL conversation id form a conversation
of their own. An empty table gives an empty result, and other columns are not read.

Conversations are sorted by Spark and pass through a task as a stream. Of a row
the first pass holds one byte, its letter, and of the cost vectors only about
twice the square root of their number; texts are met in a second pass, one at a
time, however long. So neither a conversation of a third of all rows nor a very
long text is ever held whole; one conversation is one task's work, as its hash is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import common
from .common import column

CONV, TURN, ROLE, TEXT, DIGEST, CODE = "lb_conv", "lb_turn", "lb_role", "lb_text", "lb_digest", "lb_code"

# What counts as white space, and the costs of the edits.
_SPACE = " \t\n\v\f\r"
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# A row's initial in its code, and its fault times four. ABSENT marks rows that don't count.
SYSTEM, USER, ASSISTANT, OTHER = 0, 1, 2, 3
SOUND, CUT, BLANK, DUPLICATE = 0, 4, 8, 12
ABSENT = 16

# States of (s?(ua)+)?: nothing yet, after s, after u, after a; only the first and last may end it.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: The only state that an inserted or renamed row leads to.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
#: Where a kept row leads from each state, by its initial.
KEPT = (
    {SYSTEM: AFTER_S, USER: AFTER_U},
    {USER: AFTER_U},
    {ASSISTANT: AFTER_A},
    {USER: AFTER_U},
)
#: Cost of ending in each state.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def _stay(code: int) -> int | None:
    """What it costs that a row stays; nothing for one that must go."""
    fault = code & 12
    return None if fault >= BLANK else TRUNCATED if fault == CUT else 0


def before(code: int, after: Vector) -> Vector:
    """The cost to the end from each state before a row, given that behind it."""
    stay = _stay(code)
    consumed = []
    for state in range(4):
        best = DELETE + after[state]
        if stay is not None:
            best = min(best, REROLE + stay + after[NEXT[state]])
            kept = KEPT[state].get(code & 3)
            if kept is not None:
                best = min(best, stay + after[kept])
        consumed.append(best)
    # At most two insertions before a row can pay: a third would come back to a state left.
    return tuple(
        min(consumed[q], INSERT + consumed[NEXT[q]], 2 * INSERT + consumed[NEXT[NEXT[q]]]) for q in range(4)
    )


def _emit(code: int, state: int, here: Vector, after: Vector) -> tuple[str, int]:
    """The ASCII-least tight edits up to and with a row, and the state behind it."""
    edits, stay = "", _stay(code)
    while True:
        if here[state] == DELETE + after[state]:
            return edits + "D", state
        # An insertion is tight if the rest costs its price less; its cost is that before the same row.
        if here[state] == INSERT + here[NEXT[state]]:
            edits, state = edits + "I", NEXT[state]
            continue
        kept = KEPT[state].get(code & 3)
        if kept is not None and here[state] == stay + after[kept]:
            return edits + "K", kept
        return edits + "R", NEXT[state]


def cheapest_edits(codes: bytes | bytearray) -> tuple[int, str]:
    """Cost and initials of the cheapest edits of a row of codes.

    Backwards, the cost vectors are kept at the end of each block of about the
    square root of the rows. Forwards, a block's vectors are worked out again
    from that of its end and let go when the block has been walked.
    """
    size = max(1, math.isqrt(len(codes)))
    ends: list[Vector] = []
    vector: Vector = END
    for place in range(len(codes) - 1, -1, -1):
        if (place + 1) % size == 0 or place == len(codes) - 1:
            ends.append(vector)
        vector = before(codes[place], vector)
    cost, state, edits = vector[START], START, []
    for start in range(0, len(codes), size):
        block = codes[start : start + size]
        vectors = [ends.pop()]
        for code in reversed(block):
            vectors.append(before(code, vectors[-1]))
        for code in block:
            here = vectors.pop()
            found, state = _emit(code, state, here, vectors[-1])
            edits.append(found)
    tail = {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}[state]
    return cost, "".join(edits) + tail


def coded(
    rows: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    absent: Column | None = None,
) -> DataFrame:
    """Rows under internal names; ``lb_code`` without the duplicates, which need the others.

    Rows with ``absent`` true take no part but keep their conversation in the result.
    """
    role = F.coalesce(column(role_column).cast("string"), F.lit(" "))
    text = F.coalesce(column(text_column).cast("string"), F.lit(" "))
    first = F.substring(role, 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    bare = F.btrim(text, F.lit(_SPACE))
    fault = (
        F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    )
    code = initial + fault
    if absent is not None:
        code = F.when(F.coalesce(absent, F.lit(False)), ABSENT).otherwise(code)
    return rows.select(
        column(conv_column).alias(CONV),
        column(turn_column).cast("long").alias(TURN),
        role.alias(ROLE),
        text.alias(TEXT),
        F.md5(text.cast("binary")).alias(DIGEST),
        code.cast("int").alias(CODE),
    )


def _order() -> list[Column]:
    # By code last: of rows alike the duplicates follow the first.
    return [F.col(TURN).asc_nulls_first(), F.col(ROLE).asc(), F.col(DIGEST).asc(), F.col(CODE).asc()]


_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``coded`` rows: ``lb_conv``, ``gaps``,
    ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``.

    Only ids, turns, digests and codes are shuffled, once: the duplicates are
    found by a sort within the partitions that the conversations share.
    """
    narrow = rows.select(CONV, TURN, ROLE, DIGEST, CODE).repartition(CONV)
    seen = Window.partitionBy(CONV, ROLE, DIGEST, F.col(CODE) == ABSENT).orderBy(F.col(TURN).asc_nulls_first())
    again = (F.row_number().over(seen) > 1) & (F.col(CODE) < BLANK)
    marked = narrow.withColumn(
        CODE, F.when(again, F.col(CODE).bitwiseAND(F.lit(3)) + DUPLICATE).otherwise(F.col(CODE))
    )
    ordered = marked.sortWithinPartitions(CONV, *_order()).select(CONV, TURN, CODE)
    conv = rows.schema[CONV].dataType.simpleString()
    return ordered.mapInArrow(_audits, f"{CONV} {conv}, {_COUNTS}")


class _Audit:
    """What is held of the conversation being read."""

    def __init__(self):
        self.codes = bytearray()
        self.low = self.high = None
        self.turns = 0

    def add(self, turns: pa.Array, codes: np.ndarray) -> None:
        present = codes != ABSENT
        self.codes += codes[present].astype(np.uint8).tobytes()
        found = turns.filter(pa.array(present)).drop_null().to_numpy(zero_copy_only=False)
        if len(found):
            self.turns += int(np.count_nonzero(np.diff(found))) + (self.high is None or int(found[0]) != self.high)
            self.low = int(found[0]) if self.low is None else self.low
            self.high = int(found[-1])

    def row(self) -> tuple:
        codes = np.frombuffer(bytes(self.codes), np.uint8)
        initials, faults = codes & 3, codes & 12
        pair = initials[:-1].astype(np.int64) * 4 + initials[1:]
        legal = np.isin(pair, [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = cheapest_edits(self.codes)
        faulty = [int(np.count_nonzero(faults == f)) for f in (BLANK, DUPLICATE, CUT)]
        return gaps, *faulty, int(np.count_nonzero(~legal)), cost, audit


def _runs(array: pa.Array) -> Iterator[tuple[int, int]]:
    """Starts and ends of equal neighbours."""
    codes = array.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(codes)) + 1, [len(codes)]])
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [CONV, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    current, audit, schema = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        convs, turns = batch.column(CONV), batch.column(TURN)
        codes = batch.column(CODE).to_numpy(zero_copy_only=False)
        types = [convs.type, *[pa.int64()] * 6, pa.string()]
        schema = schema or pa.schema(list(zip(names, types)))
        done = []
        for start, stop in _runs(convs):
            conv = convs[start].as_py()
            if audit is None or conv != current:
                if audit is not None:
                    done.append((current, *audit.row()))
                current, audit = conv, _Audit()
            audit.add(turns.slice(start, stop - start), codes[start:stop])
        if done:
            yield _batch(done, schema)
    if audit is not None:
        yield _batch([(current, *audit.row())], schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def repaired(rows: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: ``lb_conv``, ``place`` (from 0), ``edit`` (I, K
    or R), ``role``, ``text``. After the last row of each comes one without
    place, whose ``text`` is the SHA-256 of its ``role:text`` joined by newlines.

    Each conversation's audit heads its rows in the sorted stream, so texts pass
    one by one. ``found`` are the audits of the same rows, if they are at hand.
    """
    heads = (audits(rows) if found is None else found).select(
        CONV, F.lit(None).cast("long").alias(TURN), F.lit("").alias(ROLE), F.col("audit").alias(TEXT),
        F.lit("").alias(DIGEST), F.lit(-1).alias(CODE),
    )
    both = rows.filter(F.col(CODE) != ABSENT).unionByName(heads).repartition(CONV)
    head_first = (F.col(CODE) >= 0).asc()
    ordered = both.sortWithinPartitions(CONV, head_first, *_order()).select(CONV, ROLE, TEXT, CODE)
    conv = rows.schema[CONV].dataType.simpleString()
    return ordered.mapInArrow(_repaired, f"{CONV} {conv}, place long, edit string, role string, text string")


class _Repair:
    """Follows an audit along the rows of a conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.place, self.digest = audit, 0, START, 0, hashlib.sha256()

    def _out(self, edit: str, role: str, text: str) -> tuple:
        self.digest.update(("\n" if self.place else "").encode() + f"{role}:{text}".encode())
        self.place += 1
        return self.place - 1, edit, role, text

    def _new_role(self) -> str:
        self.state = NEXT[self.state]
        return "user" if self.state == AFTER_U else "assistant"

    def inserted(self) -> Iterator[tuple]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._out("I", self._new_role(), "")

    def row(self, role: str, text: str, code: int) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state][code & 3]
            yield self._out(edit, role, text)
        elif edit == "R":
            yield self._out(edit, self._new_role(), text)

    def end(self) -> Iterator[tuple]:
        yield from self.inserted()
        yield None, None, None, self.digest.hexdigest()


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [CONV, "place", "edit", "role", "text"]
    current, repair, schema = None, None, None
    for whole in batches:
        for batch in common.slices(iter([whole]), TEXT):
            convs = batch.column(CONV)
            schema = schema or pa.schema(
                list(zip(names, [convs.type, pa.int64(), pa.string(), pa.string(), pa.string()]))
            )
            done = []
            for conv, role, text, code in zip(*(batch.column(c).to_pylist() for c in (CONV, ROLE, TEXT, CODE))):
                if code < 0:  # a conversation's audit heads its rows
                    if repair is not None:
                        done += [(current, *r) for r in repair.end()]
                    current, repair = conv, _Repair(text)
                else:
                    done += [(conv, *r) for r in repair.row(role, text, code)]
            if done:
                yield _batch(done, schema)
    if repair is not None:
        yield _batch([(current, *r) for r in repair.end()], schema)
