from __future__ import annotations

import os
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from letterbox.llm import spelling
from letterbox.llm.queries import QUERIES, table

from ..test_queries import SF_DIR


def brute_words(rows, least_length=6, least_count=5, modulus=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least_length
    return {w: n for w, n in counts.items() if n >= least_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_near(words):
    """By deletions: words near each other share one, or one is the other's."""
    by = {}
    for w in words:
        for key in {w} | {w[:i] + w[i + 1 :] for i in range(len(w))}:
            by.setdefault(key, set()).add(w)
    return {(a, b) for group in by.values() for a in group for b in group if a != b and is_near(a, b)}


def brute(words, ratio=5):
    near = {}
    for a, b in brute_near(words):
        near.setdefault(a, []).append(b)
    form = {}
    for w, n in words.items():
        best = min(near.get(w, []), key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near.get(w, [])), words.get(form[w])))
    return sorted(out, key=repr)


def frame(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)


def found(spark, words, **settings):
    return sorted((tuple(r) for r in spelling.variants(frame(spark, words), **settings).collect()), key=repr)


def crowd(seed, number, letters="abé", least=4, most=8):
    rng = random.Random(seed)
    return {"".join(rng.choice(letters) for _ in range(rng.randrange(least, most))): rng.randrange(1, 400) for _ in range(number)}


@pytest.mark.parametrize("most", [None, 40, 3])
def test_variants_equal_brute_force_also_in_split_partitions(spark, most):
    words = crowd(1, 700)
    assert found(spark, words, most=most) == brute(words)


def test_each_pair_is_accepted_once(spark):
    words = crowd(5, 300, letters="ab", most=10)
    for most in (None, 2):
        pairs = [(r.word, r.other) for r in spelling.near(frame(spark, words), most).collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == brute_near(words)


def test_very_long_words_and_shared_beginnings(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("abc") for _ in range(3000))
    words = {base: 50, base[:1500] + "x" + base[1500:]: 7, base[:-1]: 9, "x" + base[1:]: 10, base + "y": 10, base[:-1] + "z": 3}
    words |= {"shared" * 4 + w: n for w, n in crowd(3, 60).items()}
    assert found(spark, words, most=20) == brute(words)


def test_chains_of_forms_end_at_the_root(spark):
    words = {"colour" + "s" * i: 5 * 6**i for i in range(9)}
    answer = {w: root for w, _, root, *_ in found(spark, words)}
    assert set(answer.values()) == {"colour" + "s" * 8}


def test_ties_take_the_smallest_near_word(spark):
    words = {"letter": 2, "better": 50, "lettér": 50, "setter": 50}
    assert next(r for r in found(spark, words) if r[0] == "letter")[1] == "better"
    assert found(spark, words) == brute(words)


def test_no_words(spark):
    assert found(spark, {"alone": 5}) == [("alone", None, "alone", 5, 0, None)]
    assert spelling.variants(frame(spark, {"alone": 5}).limit(0)).count() == 0


def counts(docs, **settings):
    return {r.word: r.n for r in spelling.word_counts(docs, **settings).collect()}


def test_word_counts_equal_brute_force(odd, documents, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert counts(odd, least_length=2, least_count=1, modulus=3) == brute_words(rows, 2, 1, 3)
    text = "Éclair ÉCLAIR éclair Straße×÷ naïve_naïve Ünïcode ſtrange Ａwide łódka " * 3
    many = [(i if i % 4 else None, text.replace("Straße", "Stra ße") if i % 2 else text) for i in range(40)]
    assert counts(documents(many), modulus=2) == brute_words(many, modulus=2)
    assert counts(none) == {}


def test_the_acceptor_is_minimal_and_accepts_its_words():
    words = sorted(crowd(2, 200))
    acceptor = spelling.Acceptor(words)

    def language(state):
        own = [""] if acceptor.final[state] else []
        return own + [c + rest for c, to in acceptor.arcs[state].items() for rest in language(to)]

    assert sorted(language(acceptor.start)) == words
    sets = [tuple(sorted(language(s))) for s in range(len(acceptor.arcs))]
    assert len(sets) == len(set(sets))


def test_splits_keep_partitions_small(spark):
    words = {f"prefix{w}suffix": n for w, n in crowd(7, 600, least=5).items()}
    dealt = spelling.partitions(frame(spark, words), most=30)
    sizes = dealt.groupBy("lb_key").agg(F.count("*").alias("n"), F.max(F.expr("lb_size - lb_left - lb_right")).alias("open"))
    assert sizes.filter("n > 30 AND open > 1").isEmpty() and not sizes.isEmpty()


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_the_query_equals_brute_force_on_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect()]
    answer = QUERIES["op13_spelling_variants"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in answer), key=repr) == brute(brute_words(rows))
