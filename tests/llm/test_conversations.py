from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from letterbox.llm import conversations as conv
from letterbox.llm.queries import QUERIES, damaged, table

from ..test_queries import SF_DIR

SPACE = " \t\n\v\f\r"
ROLES = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """The first fault of each row of (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute_edits(rows):
    """Cheapest edits by best-first search over (cost, audit) with the roles' initials checked by the pattern."""
    fault = faults(rows)
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heappop(heap)
        if at == len(rows) and ROLES.fullmatch(roles):
            return cost, audit
        state = (at, roles[-1:] or "-")
        if state in done:
            continue
        done.add(state)

        def go(price, edit, to, role):
            grown = roles + role
            if any(ROLES.fullmatch(grown + end) for end in ("", "ua", "a")):
                heappush(heap, (cost + price, audit + edit, to, grown))

        for role in "ua":
            go(2, "I", at, role)
        if at < len(rows):
            stays = fault[at] == "truncated"
            go(3, "D", at + 1, "")
            if fault[at] not in ("blank", "duplicate"):
                initial = rows[at][0][:1]
                if initial:
                    go(stays, "K", at + 1, initial)
                for role in "ua":
                    go(2 + stays, "R", at + 1, role)
    raise AssertionError("no repair")


def brute_repair(rows, audit):
    at, roles, out = 0, "", []
    turn = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    for edit in audit:
        if edit == "I":
            out.append((turn[roles[-1:]], ""))
        else:
            role, text = rows[at]
            at += 1
            if edit == "D":
                continue
            out.append((role if edit == "K" else turn[roles[-1:]], text))
        roles += out[-1][0][0]
    assert at == len(rows) and ROLES.fullmatch(roles)
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def brute(rows):
    """``rows`` of (conv, turn, role, text, present) to one tuple per conversation."""
    groups = defaultdict(list)
    for c, turn, role, text, present in rows:
        group = groups[c]
        if present:
            role, text = " " if role is None else role, " " if text is None else text
            digest = hashlib.md5(text.encode()).hexdigest()
            group.append((turn is not None, turn or 0, role, digest, text))
    out = []
    for c, group in groups.items():
        group = sorted(group)
        turns = [t for known, t, *_ in group if known]
        plain = [(role, text) for _, _, role, _, text in group]
        fault = faults(plain)
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(plain, plain[1:]))
        cost, audit = brute_edits(plain)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [fault.count(f) for f in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, illegal, cost, audit, brute_repair(plain, audit)))
    return sorted(out, key=repr)


def found(rows):
    audits = conv.audits(rows)
    digests = {r[0]: r.text for r in conv.repaired(rows).filter("place IS NULL").collect()}
    return sorted(((*r, digests[r[0]]) for r in audits.collect()), key=repr)


SCHEMA = "conv_id long, turn long, role string, text string, lb_code int, cost string, present boolean"


def frame(spark, rows):
    df = spark.createDataFrame([(*r[:4], 1, "x", r[4]) for r in rows], SCHEMA).repartition(3)
    return conv.coded(df, absent=~F.col("present"))


def random_rows(seed, conversations, most=14):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "What", "", " \t", "Why not?  ", "é", "and so on", None]
    out = []
    for c in range(conversations):
        for t in range(rng.randrange(1, most)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            turn = None if rng.random() < 0.05 else t + rng.randrange(2)
            out.append((c, turn, role, rng.choice(texts) if rng.random() < 0.5 else f"Turn {t}.", rng.random() < 0.9))
    return out


def test_repairs_equal_brute_force(spark):
    rows = random_rows(2, 120)
    assert found(frame(spark, rows)) == brute(rows)


def test_null_conversations_and_empty_ones(spark):
    rows = [
        (None, None, None, None, True),
        (None, 1, "user", "A question?", True),
        (5, 1, "user", "All of it was dropped.", False),
        (6, None, "system", "Only this.", True),
        (7, 3, "assistant", "Twice.", True),
        (7, 3, "assistant", "Twice.", True),
        (7, 9, "user", "Never ends", True),
    ]
    answer = found(frame(spark, rows))
    assert answer == brute(rows)
    empty = next(r for r in answer if r[0] == 5)
    assert empty[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(frame(spark, rows).limit(0)) == []


def test_a_long_conversation_with_very_long_texts(spark):
    rows = [(1, i // 2, "user" if i % 3 else "assistant", f"Said {i}." if i % 7 else "cut off", True) for i in range(900)]
    rows += [(2, i, r, "a very long text " * 150_000 + e, True) for i, (r, e) in enumerate([("user", "?"), ("user", "."), ("tool", "")])]
    assert found(frame(spark, rows)) == brute(rows)


def test_repaired_rows_are_returned_with_their_texts(spark):
    rows = frame(spark, [(1, 0, "system", "Be kind.", True), (1, 1, "assistant", "Hello.", True), (1, 2, "user", "", True)])
    out = [tuple(r)[1:] for r in conv.repaired(rows).filter("place IS NOT NULL").orderBy("place").collect()]
    assert out == [(0, "K", "system", "Be kind."), (1, "I", "user", ""), (2, "K", "assistant", "Hello.")]


@pytest.mark.parametrize("length", [1, 2, 3, 4, 15, 16, 17, 100, 101])
def test_checkpoints_give_the_edits_of_the_whole_table(length):
    rng = random.Random(length)
    codes = bytes(rng.randrange(16) for _ in range(length))
    vectors = [conv.END]
    for code in reversed(codes):
        vectors.append(conv.before(code, vectors[-1]))
    vectors.reverse()
    state, edits = conv.START, ""
    for i, code in enumerate(codes):
        found, state = conv._emit(code, state, vectors[i], vectors[i + 1])
        edits += found
    cost, audit = conv.cheapest_edits(codes)
    assert cost == vectors[0][conv.START] and audit.startswith(edits) and set(audit[len(edits) :]) <= {"I"}


def test_only_checkpoints_and_a_block_of_vectors_are_held(monkeypatch):
    import gc

    class Counted(tuple):
        live = most = 0

        def __new__(cls, values):
            cls.live += 1
            cls.most = max(cls.most, cls.live)
            return super().__new__(cls, values)

        def __del__(self):
            type(self).live -= 1

    plain = conv.before
    monkeypatch.setattr(conv, "before", lambda code, after: Counted(plain(code, after)))
    gc.disable()
    conv.cheapest_edits(bytes(i * 7 % 16 for i in range(10_000)))
    gc.enable()
    assert Counted.most <= 2 * math.isqrt(10_000) + 10


@pytest.mark.skipif(not __import__("os").path.isdir(SF_DIR), reason="no test tables")
def test_the_query_equals_brute_force_on_the_whole_table(spark):
    rows = []
    for r in table(spark, SF_DIR, "conversations").collect():
        c, t, role, text = (" " if v is None else v for v in r)
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(r.conv_id, r.turn, "user" if fault == 4 else role, text, fault != 0)] * (2 if fault == 3 else 1)
    answer = QUERIES["op12_conversation_repair"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in answer), key=repr) == brute(rows)


def test_nulls_count_as_one_space_in_the_damage(spark):
    rows = [(None, None, None, None), (None, 4, "user", None), (3, None, None, "x.")]
    df = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    expected = []
    for c, t, role, text in rows:
        c, t, role, text = (" " if v is None else v for v in (c, t, role, text))
        fault = zlib.crc32(f"{c}:{t}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        expected += [("user" if fault == 4 else role, text, fault == 0)] * (2 if fault == 3 else 1)
    assert sorted((r.role, r.text, r.lb_absent) for r in df.collect()) == sorted(expected)
