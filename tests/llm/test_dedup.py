from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings, strategies as st

from letterbox.llm import exact_dedup, simhash
from letterbox.llm.common import ID
from letterbox.llm.components import components

from .conftest import WORDS


def same(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_exact(rows):
    """One tuple per row: id, keep_id, size, kept, digest."""
    groups = {}
    for i, text in rows:
        groups.setdefault(same(text), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            digest = hashlib.sha256(text.encode()).hexdigest()
            out.append((i, keep, len(ids), i == keep and first, digest))
            first = False
    return sorted(out, key=repr)


def exact(docs):
    found = exact_dedup.exact_duplicates(docs, digest_all=True).collect()
    return sorted(((r[ID], r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=repr)


def test_exact_duplicates_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert exact(odd) == brute_exact(rows)
    kept = exact_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    left = [same(r.text) for r in kept.collect()]
    assert len(left) == len(set(left)) == len({same(t) for _, t in rows})
    assert {r.doc_id for r in kept.collect()} == {1, 2, 4, 5, 7, 8, None}


def test_many_repeats_of_a_row_are_counted_within_their_tasks(documents):
    crowd = documents([(None, "same text")] * 6000).repartition(6)
    docs = crowd.unionByName(documents([(3, "same  text"), (3, "same  text")]))
    found = exact_dedup.exact_duplicates(docs).groupBy(ID, "keep_id", "group_size", "kept").count().collect()
    assert {(r[ID], r.keep_id, r.group_size, r.kept): r["count"] for r in found} == {
        (None, 3, 6002, False): 6000,
        (3, 3, 6002, True): 1,
        (3, 3, 6002, False): 1,
    }
    assert exact_dedup.exact_duplicates(crowd).filter("kept").count() == 1
    assert exact_dedup.drop_exact_duplicates(docs).count() == 1


def test_full_hashes_are_taken_of_survivors_only(documents):
    docs = documents([(1, "alone"), (2, "pair  x"), (3, "pair x"), (4, "pair y")])
    found = {r[ID]: r for r in exact_dedup.exact_duplicates(docs).collect()}
    assert found[1].text_sha256 is None and found[1].settled_by == "prefix"
    assert found[4].text_sha256 is None  # same length, another prefix
    assert found[2].text_sha256 == found[3].text_sha256 and not found[3].kept


def test_texts_equal_in_length_and_prefix_are_told_apart(documents):
    docs = documents([(1, "a" * 900 + "b"), (2, "a" * 900 + "c"), (3, "a" * 900 + "b")])
    assert exact(docs) == brute_exact([(1, "a" * 900 + "b"), (2, "a" * 900 + "c"), (3, "a" * 900 + "b")])


def test_a_hot_group_and_repeated_rows(documents):
    rng = random.Random(1)
    rows = [(i, "hot text") for i in range(500)] + [(rng.randrange(40), f"t{rng.randrange(60)}") for _ in range(900)]
    rows += [(i + 2000, f"single {i}") for i in range(300)]
    docs = documents(rows)
    assert exact(docs) == brute_exact(rows)
    assert exact_dedup.drop_exact_duplicates(docs).count() == len({t for _, t in rows})


def test_empty_tables(none):
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    left = simhash.drop_near_duplicates(none)
    assert left.count() == 0 and left.columns == none.columns


def test_the_plan_runs_no_python(documents):
    plan = exact_dedup.exact_duplicates(documents([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_mark(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = WORDS.findall(lowered)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks, distance=4):
    root = list(range(len(marks)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(marks):
        for j in range(i):
            if (a ^ marks[j]).bit_count() <= distance:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(marks))]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab AB É\n\tß　", max_size=60))
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text.encode()) == brute_mark(text)


def near(docs):
    return [(r[ID], r.fingerprint, r.component_id, r.kept) for r in simhash.near_duplicates(docs).collect()]


def expected_near(rows):
    marks = [brute_mark(t) for _, t in rows]
    roots = brute_components(marks)
    least = {}
    for (i, _), root in zip(rows, roots):
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    return sorted(((i, f"{m:016x}", least[r]) for (i, _), m, r in zip(rows, marks, roots)), key=repr)


def test_near_duplicates_of_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((x[:3] for x in near(odd)), key=repr) == expected_near(rows)
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    assert left.count() == len(set(brute_components([brute_mark(t) for _, t in rows])))


def test_near_copies_in_chains_and_crowds(documents):
    rng = random.Random(5)
    base = [f"w{rng.randrange(400)}" for _ in range(400)]
    rows = []
    for i in range(160):  # each a little further from the first
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(400)] = f"n{rng.randrange(99)}"
        base = copy if i % 3 == 0 else base
        rows.append((1000 - i, " ".join(copy)))
    rows += [(i, " ".join(f"x{rng.randrange(5000)}" for _ in range(60))) for i in range(100)]
    assert sorted((x[:3] for x in near(documents(rows))), key=repr) == expected_near(rows)


def marks_frame(spark, marks):
    return spark.createDataFrame([(int(m) - (1 << 64) if int(m) >> 63 else int(m),) for m in marks], "lb_mark long")


def test_links_miss_no_pair_with_any_number_of_blocks_and_tiles(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 6, dtype=np.uint64)
    marks = set()
    for k in range(400):
        flips = np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, rng.integers(0, 6), replace=False).astype(np.uint64)) if k % 5 else np.uint64(0)
        marks.add(int(centres[k % 6] ^ flips))
    marks = sorted(marks)
    roots = brute_components(marks)
    frame = marks_frame(spark, marks)
    monkeypatch.setattr(simhash, "TILE", 25)  # larger buckets are compared tile by tile
    for blocks in (5, 7, 8):
        found = {r.node % (1 << 64): r.component % (1 << 64) for r in components(simhash.links(frame, 4, blocks)).collect()}
        of = [found.get(m, m) for m in marks]
        pairs = {(roots[i], of[i]) for i in range(len(marks))}
        assert len(pairs) == len(set(roots)) == len(set(of))


def test_block_masks_cover_all_bits_once():
    masks = simhash.block_masks(4, 5)
    assert sum(masks) == (1 << 64) - 1 and len(masks) == 5
    assert len(simhash.block_masks(4, 7)) == 35


def test_trees_are_shallow():
    marks = np.arange(1000, dtype=np.int64)
    (parent, child), = simhash.linked(marks, 64)
    assert len(child) == 999 and np.unique(parent, return_counts=True)[1].max() <= 16


def test_components_of_a_long_path(spark):
    n = 300
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}
