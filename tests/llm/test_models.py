from __future__ import annotations

import math
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from letterbox.llm import language_gru, quality_knn, toxicity
from letterbox.llm.common import ID, byte_view, held_out

rng = random.Random(11)
SYLLABLES = {"en": ["the", "ing", "wh", "ou"], "de": ["sch", "ung", "ä", "ei"], "fr": ["eau", "é", "que", "ç"]}


def prose(lang="en", n=80):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def junk(n=80):
    kind = rng.randrange(2)
    return " ".join([prose(n=1)] * n) if kind else " ".join(w + "###" for w in prose(n=n).split())


def test_held_out_is_crc32_of_the_id(spark):
    rows = spark.range(200).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


# Quality ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def quality(spark, documents):
    texts = [(i, prose(rng.choice(list(SYLLABLES))) if i % 4 else junk()) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), None) for i, _ in texts], "doc_id long, quality int, toxic int")
    docs = documents(texts)
    return texts, docs, labels, quality_knn.fit(docs, labels, usable=~held_out(F.col(ID), 5, 0), dimensions=16)


def brute_score(model, text):
    """One text against every labelled vector, one by one."""
    counts, repeats = quality_knn.terms(*byte_view(pa.array([text or ""])))
    vector = quality_knn.weighted(counts, repeats, model.idf)[0] @ model.axes
    size = np.linalg.norm(vector)
    if not size:
        return float(model.labels.mean())
    cosines = sorted(((float(v @ vector / size), y) for v, y in zip(model.vectors, model.labels)), key=lambda x: -x[0])
    weights = [max(c, 0) ** model.power for c, _ in cosines[: model.neighbours]]
    return sum(w * y for w, (_, y) in zip(weights, cosines)) / sum(weights)


def test_scores_equal_brute_force_and_tell_junk(quality):
    texts, docs, _, model = quality
    found = {r[ID]: r.score for r in quality_knn.score(docs, model).collect()}
    for i, text in texts:
        assert found[i] == pytest.approx(brute_score(model, text), abs=1e-3)
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(found[i] >= 0.3) == (i % 4 > 0) for i in held]) > 0.95


def test_labels_of_held_out_rows_are_not_learned(spark, quality):
    texts, docs, labels, model = quality
    flipped = labels.withColumn("quality", F.when(held_out(F.col("doc_id"), 5, 0), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_knn.fit(docs, flipped, usable=~held_out(F.col(ID), 5, 0), dimensions=16)
    assert np.array_equal(again.labels, model.labels) and np.allclose(again.vectors, model.vectors)


def test_trigrams_do_not_run_across_texts():
    both, _ = quality_knn.terms(*byte_view(pa.array(["abc", "def"])))
    alone, _ = quality_knn.terms(*byte_view(pa.array(["def"])))
    assert (both[1] == alone[0]).all() and both.sum() == 2
    for tiny in (["a"], [""], [], ["ab", ""]):
        counts, repeats = quality_knn.terms(*byte_view(pa.array(tiny, pa.string())))
        assert counts.sum() == 0 and len(repeats) == len(tiny)


def test_quality_of_odd_rows(spark, quality, odd, none):
    _, docs, labels, model = quality
    rows = quality_knn.score(odd, model).collect()
    assert len(rows) == 12 and all(0 <= r.score <= 1 for r in rows)
    base = float(model.labels.mean())
    assert all(r.score == pytest.approx(base) for r in rows if r[ID] in (2, 3))
    kept = quality_knn.keep_good(odd, model, 0.3)
    assert kept.schema.simpleString() == odd.schema.simpleString()
    assert kept.count() == sum(r.score >= 0.3 for r in rows)
    assert quality_knn.keep_good(odd, model, 0.0).exceptAll(odd).count() == 0
    assert quality_knn.score(none, model).count() == 0 and quality_knn.keep_good(none, model).count() == 0
    unlabelled = quality_knn.fit(docs, labels.limit(0))
    assert {r.score for r in quality_knn.score(odd, unlabelled).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(1, None), (None, 1), (5, 7), (6, 1), (6, 0), (6, 1)], "doc_id long, quality int")
    assert quality_knn.fit(odd, odd_labels).labels.tolist() == [1.0]


def test_the_sample_is_bounded(quality):
    _, docs, labels, _ = quality
    assert len(quality_knn.fit(docs, labels, max_labelled=40).labels) == 40


def test_the_fit_takes_little_of_the_drivers_memory(spark, monkeypatch):
    n = 3000
    docs = spark.range(n).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 40), i -> hex(hash(id, i))), ' ') AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS quality")
    whole, got, collect = n * (quality_knn.TERMS + quality_knn.LAGS) * 4, [], type(docs).toArrow

    def watched(df):
        got.append(collect(df))
        tracemalloc.start()
        return got[-1]

    monkeypatch.setattr(type(docs), "toArrow", watched)
    try:
        model = quality_knn.fit(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model.vectors.shape == (n, 64)
    assert sum(t.nbytes for t in got) < 0.4 * whole
    square = (quality_knn.TERMS + quality_knn.LAGS) ** 2 * 8
    # numpy's own: the rows once and the matrix in both precisions, or the decomposition's input and output.
    assert peak < max(whole + 1.5 * square, 2 * square) + 25e6


def test_the_fit_is_that_of_the_whole_matrix(spark, documents):
    texts = [(i, prose(n=3 + i % 90) if i % 5 else "x " * i) for i in range(600)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, quality int")
    model = quality_knn.fit(documents(texts), labels)
    counts, repeats = quality_knn.terms(*byte_view(pa.array([t for _, t in texts])))
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    found = quality_knn.weighted(counts, repeats, idf)
    values, axes = np.linalg.eigh((found.T @ found).astype(np.float64))
    vectors = found @ axes[:, np.argsort(values)[::-1][:64]].astype(np.float32)
    assert np.array_equal(model.idf, idf)
    assert np.allclose(model.vectors @ model.vectors.T, quality_knn._unit(vectors) @ quality_knn._unit(vectors).T, atol=1e-4)


# Language --------------------------------------------------------------------------------


def test_gradients_equal_finite_differences():
    draw = np.random.default_rng(0)
    net = language_gru.Network.fresh(["a", "b", "c"], draw, units=4)
    for group in (net.input, net.state, net.out):
        group[:] = [p.astype(np.float64) for p in group]
    net.bias = net.bias.astype(np.float64)
    windows, targets = draw.integers(97, 110, (6, 5)), draw.integers(0, 3, 5)
    _, grads = language_gru.gradients(net, windows, targets)
    for p, g in zip(net.parameters(), grads):
        for _ in range(20):
            at = tuple(draw.integers(0, s) for s in p.shape)
            at = (at[0], int(draw.integers(97, 110))) if p.shape[-1] == 256 else at
            was, e = p[at], 1e-5
            p[at] = was + e
            up = language_gru.gradients(net, windows, targets)[0]
            p[at] = was - e
            down = language_gru.gradients(net, windows, targets)[0]
            p[at] = was
            assert (up - down) / (2 * e) == pytest.approx(g[at], abs=1e-6)


def brute_distribution(net, text):
    """Byte by byte, window by window."""
    total, data = np.zeros(len(net.languages)), text.encode()
    for at in range(0, len(data), language_gru.WINDOW):
        window = data[at : at + language_gru.WINDOW]
        states = []
        for way, order in enumerate((window, window[::-1])):
            h, seen = np.zeros((language_gru.UNITS, 1), np.float32), []
            for byte in order:
                h = language_gru.step(net.input[way][:, [byte]], net.state[way], h)[0]
                seen.append(h)
            states.append(seen)
        for ahead, behind in zip(states[0], states[1][::-1]):
            total += language_gru.softmax(net.out[0] @ ahead + net.out[1] @ behind + net.bias)[:, 0]
    return total / max(len(data), 1)


@pytest.fixture(scope="module")
def net(documents):
    texts = [(i, prose(lang, rng.randint(5, 90)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=240))]
    docs = documents(texts)
    return texts, docs, language_gru.fit(docs, usable=~held_out(F.col(ID), 4, 2), updates=60)


def test_predictions_equal_brute_force(net):
    network = net[2]
    texts = ["", "a", prose(n=200), prose("de", 3), "x" * language_gru.WINDOW, "é" * 200]
    found = language_gru.predict(network, *byte_view(pa.array(texts)))
    for row, text in zip(found, texts):
        assert row == pytest.approx(brute_distribution(network, text), abs=1e-4)


def test_languages_are_told_on_held_out_rows(net):
    texts, docs, network = net
    found = {r[ID]: r.lang_pred for r in language_gru.language(docs, network).collect()}
    held = [(i, lang) for i, _, lang in texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([found[i] == lang for i, lang in held]) > 0.95


def test_language_of_odd_rows(net, odd, none, documents):
    rows = language_gru.language(odd, net[2]).collect()
    by_id = {r[ID]: r for r in rows if r[ID] is not None}
    assert len(rows) == 12
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (2, 3, 4, 8))
    assert all(r.lang_pred in ("und", "en", "de", "fr") and 0 <= r.score <= 1 for r in rows)
    assert language_gru.language(none, net[2]).count() == 0
    blank = language_gru.fit(none)
    assert {r.lang_pred for r in language_gru.language(odd, blank).collect()} == {"und"}
    one = language_gru.fit(documents([(1, "abc", "en"), (2, "", "en"), (3, None, "en")]))
    assert language_gru.language(odd, one).filter("lang_pred = 'en'").count() > 0


def test_many_stray_languages_neither_stop_nor_spoil_the_others(documents):
    texts = [(i, prose(lang, rng.randint(5, 90)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=900))]
    stray = [(10_000 + i, prose(rng.choice(list(SYLLABLES))), f"x-{i:03}") for i in range(language_gru.MAX_LANGUAGES + 50)]
    docs = documents(texts + stray)
    with pytest.warns(UserWarning, match="most frequent"):
        network = language_gru.fit(docs, usable=(F.col(ID) >= 10_000) | ~held_out(F.col(ID), 4, 2))
    assert len(network.languages) == language_gru.MAX_LANGUAGES and set(SYLLABLES) < set(network.languages)
    rows = language_gru.language(docs, network).collect()
    assert len(rows) == len(texts) + len(stray)
    found = {r[ID]: r.lang_pred for r in rows}
    assert np.mean([found[i] == lang for i, _, lang in texts if zlib.crc32(str(i).encode()) % 4 == 2]) > 0.9


# Toxicity --------------------------------------------------------------------------------


def brute_segments(values):
    """Maximal segments by their definition: the best one, then those left and right of it."""
    best = None
    for a in range(len(values)):
        for b in range(a, len(values)):
            total = sum(values[a : b + 1])
            if total > 1e-12 and (best is None or total > best[2] + 1e-12):
                best = (a, b, total)
    if best is None:
        return []
    a, b, _ = best
    right = [(x + b + 1, y + b + 1, s) for x, y, s in brute_segments(values[b + 1 :])]
    return [*brute_segments(values[:a]), best, *right]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 3, 5, 11, -2, -6]), max_size=16), st.sampled_from([0.7, 2.1, 4.3]))
def test_segments_equal_their_definition(weights, drift):
    at = np.flatnonzero(weights)
    given = np.array([float(w) + 0.013 * i for i, w in enumerate(weights)])[at]
    values = [-drift] * len(weights)
    for i, w in zip(at, given):
        values[i] = w
    found = toxicity.segments(at, given, drift)
    expected = brute_segments(values)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
    assert [s for *_, s in found] == pytest.approx([s for *_, s in expected])


@pytest.mark.parametrize(("clean", "passages"), [(20, 1), (39, 1), (41, 2), (60, 2), (200, 2)])
def test_how_many_clean_tokens_part_two_passages(clean, passages):
    """Two passages of two tokens of the least weight are two when 60 clean tokens lie between, as the README says."""
    at = np.array([0, 1, clean + 2, clean + 3])
    assert len(toxicity.segments(at, np.full(4, toxicity.LEAST_LOG_ODDS))) == passages


def test_tokens_are_lowered_and_stay_in_their_text():
    code, distinct, counts = toxicity.tokens(*byte_view(pa.array(["ÉA éa, X", "9x-Y", "", "ß×"])))
    assert [distinct[int(c)] for c in code] == ["éa", "éa", "x", "9x", "y", "ß×"] and counts.tolist() == [3, 2, 0, 1]


def test_the_law_holds_on_random_scores():
    draw = np.random.default_rng(5)
    rate = toxicity.law([(2.0, 0.002), (3.0, 0.001)])
    assert 0.002 * math.exp(2 * rate) + 0.001 * math.exp(3 * rate) + 0.997 * math.exp(-rate * toxicity.DRIFT) == pytest.approx(1)
    best = []
    for _ in range(3000):
        at = np.flatnonzero(draw.random(1000) < 0.003)
        found = toxicity.segments(at, draw.choice([2.0, 3.0], len(at), p=[2 / 3, 1 / 3]))
        best.append(max((s for *_, s in found), default=0))
    # Each step up makes a best score rarer by the rate, beyond a single token's weight.
    a, b = np.mean(np.array(best) > 3.2), np.mean(np.array(best) > 5.2)
    assert math.log(a / b) / 2 == pytest.approx(rate, rel=0.35)


@pytest.fixture(scope="module")
def toxic(spark, documents):
    bad = ["vilest", "loathsome", "wretch"]
    rows = []
    for i in range(500):
        found = prose(rng.choice(list(SYLLABLES)), rng.randint(20, 120)).split()
        if i % 5 == 0:
            for _ in range(rng.randint(3, 6)):
                found.insert(rng.randrange(len(found)), rng.choice(bad))
        rows.append((i, " ".join(found)))
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    return rows, docs, labels, toxicity.fit(docs, labels, usable=~held_out(F.col(ID), 5, 0))


def test_toxic_texts_are_caught_and_clean_ones_left_alone(toxic):
    rows, docs, _, model = toxic
    bad = {w for w, weight in model.words.items() if weight > 0}
    assert bad == {"vilest", "loathsome", "wretch"}
    found = {r[ID]: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((found[i].score >= 0.5) == (i % 5 == 0) for i in held)
    for i, text in rows:
        words = text.lower().split()
        for p in found[i].passages:
            assert words[p["first"]] in bad and words[p["last"]] in bad
        assert bool(found[i].passages) == (i % 5 == 0)


def test_toxicity_of_odd_rows(spark, toxic, odd, none):
    _, docs, labels, model = toxic
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == 12 and all(0 <= r.score < 0.5 and r.passages == [] for r in rows)
    assert toxicity.score(none, model).count() == 0
    for lacking in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        blank = toxicity.fit(docs, lacking)
        assert {r.score < 1e-9 for r in toxicity.score(odd, blank).collect()} == {True}
    odd_labels = spark.createDataFrame([(1, None), (None, 1), (5, 7), (6, 1), (6, 0), (4, 0)], "doc_id long, toxic int")
    assert toxicity.score(odd, toxicity.fit(odd, odd_labels)).count() == 12


def plain_lexicon(rows, feature):
    """Weights by the definition: distinct contexts of each kind, log-odds under the pooled prior, significance."""
    kinds = {}
    for text, label in rows:
        words = text.lower().split()
        for a, w, b in zip(["", *words], words, [*words[1:], ""]):
            if feature(w):
                kinds.setdefault(feature(w), {}).setdefault((a, b), set()).add(label)
    y = {f: sum(1 in ls for ls in at.values()) for f, at in kinds.items()}
    c = {f: sum(0 in ls for ls in at.values()) for f, at in kinds.items()}
    all_y, all_c = sum(y.values()), sum(c.values())
    prior, out = 0.1 * (all_y + all_c), {}
    for f in kinds:
        a = 0.1 * (y[f] + c[f])
        odds = math.log((y[f] + a) / (all_y + prior - y[f] - a)) - math.log((c[f] + a) / (all_c + prior - c[f] - a))
        z = odds / math.sqrt(1 / (y[f] + a) + 1 / (c[f] + a))
        if odds > 2 and z > 3.5 or z < -3.5:
            out[f] = odds
    return out


def test_lexicon_and_scores_equal_their_definition(toxic):
    rows, docs, labels, model = toxic
    usable = [(t, int(i % 5 == 0)) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 0]
    assert model.words == pytest.approx(plain_lexicon(usable, lambda w: w))
    assert model.stems == pytest.approx(plain_lexicon(usable, lambda w: w[:5] if len(w) >= 5 else ""))
    found = {r[ID]: r for r in toxicity.score(docs, model).collect()}
    for i, text in rows[:60]:
        words = text.lower().split()
        own = [model.words.get(w) or model.stems.get(w[:5], 0.0) for w in words]
        values = [w if w > 0 else w - toxicity.DRIFT for w in own]
        expected = [math.log(model.size * len(words)) - model.rate * s for *_, s in brute_segments(values)]
        total = 0.0
        if expected:
            best, *others = sorted(expected)
            total = -math.log(-math.expm1(-math.exp(min(best, 50)))) if best > -20 else -best
            total += sum(max(0.0, -e - math.log(1000)) for e in others)
        assert found[i].score == pytest.approx(1 / (1 + math.exp(-max(-50, min(50, model.bias + model.slope * total)))), abs=1e-6)


def test_tokens_of_clean_texts_weigh_less_than_nothing(spark, documents):
    draw = random.Random(4)
    rows = []
    for i in range(400):
        words = prose("en", 40).split()
        for _ in range(6):
            words.insert(draw.randrange(len(words)), "loathsome" if i % 2 else "pleasant")
        rows.append((i, " ".join(words)))
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(documents(rows), labels)
    assert model.words["pleasant"] < -1 < 2 < model.words["loathsome"]


def test_calibration_meets_texts_unknown_to_the_weights(toxic, monkeypatch):
    """Each fold is scored with the weights of the others."""
    rows, docs, labels, _ = toxic
    models = []
    build = toxicity._model
    monkeypatch.setattr(toxicity, "_model", lambda w, s: models.append(build(w, s)) or models[-1])
    toxicity.fit(docs, labels)
    assert len(models) == 1 + toxicity.FOLDS and len({tuple(sorted(m.words.items())) for m in models}) == 1 + toxicity.FOLDS


def test_copies_count_once(spark, documents):
    """A passage that many copies share must not look toxic because its copies are labelled so."""
    shared = prose("de", 60) + " peculiar " + prose("de", 20)
    rows = [(i, shared) for i in range(60)] + [(i, prose("en", 60)) for i in range(60, 200)]
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in rows], "doc_id long, toxic int")
    assert "peculiar" not in toxicity.fit(documents(rows), labels).words
