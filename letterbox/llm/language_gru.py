"""Language of a text by a bidirectional gated recurrent network over its bytes.

Two recurrent layers read windows of the bytes, one from each end; every byte
gets a distribution over languages from both states, and a text's distribution
is the mean over all its bytes. The network is trained in numpy by
backpropagation through time on a bounded sample of windows; gates and
candidates are clipped lines instead of sigmoids, which costs little to
evaluate. Every byte of every text is read, in windows that start from the zero
state, so work is linear and memory bounded also for very long texts.

A NULL text, or one without a letter, is ``und`` with score 0. Rows that repeat
get equal results; NULL ids are carried through. An empty table gives an empty
result; without a labelled row every text is ``und``. Of very many languages the
most frequent are learned; of languages with equal shares of a text the first by
name is told.
"""

from __future__ import annotations

import math
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import small_rows
from . import common
from .common import ID, TEXT, column

#: State of each direction.
UNITS = 8
#: Bytes of a window when predicting, and when training.
WINDOW, TRAINING_WINDOW = 128, 48
#: Windows worked on at once: what a step touches stays in the cache.
TOGETHER = 4096
#: The sample: labelled documents at most (smallest hash of their id), windows of each, and languages.
MAX_LABELLED, WINDOWS_EACH, MAX_LANGUAGES = 3000, 3, 200
#: A language with less than this part of the commonest one's windows is drawn less often.
RARE = 10

UNDETERMINED = "und"


@dataclass
class Network:
    """Weights; gates are stacked: update, reset, candidate. ``input`` holds a column for each byte."""

    languages: list[str]
    input: list[np.ndarray]  # of each direction: (3 * units, 256), biases included
    state: list[np.ndarray]  # of each direction: (3 * units, units)
    out: list[np.ndarray]  # of each direction: (languages, units)
    bias: np.ndarray  # (languages, 1)

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator, units: int = UNITS) -> Network:
        def normal(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        given = [normal(3 * units, 256, scale=0.3) for _ in range(2)]
        for table in given:
            table[: 2 * units] += 0.5  # gates start half open
        state = [normal(3 * units, units, scale=0.3) for _ in range(2)]
        out = [normal(len(languages), units, scale=0.3) for _ in range(2)]
        return cls(languages, given, state, out, np.zeros((len(languages), 1), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*self.input, *self.state, *self.out, self.bias]


def step(given: np.ndarray, state: np.ndarray, h: np.ndarray):
    """One step of one direction: the new state and what backpropagation needs of it."""
    units = len(h)
    inner = state @ h
    gates = np.clip(given[: 2 * units] + inner[: 2 * units], 0, 1)
    update, reset = gates[:units], gates[units:]
    candidate = np.clip(given[2 * units :] + reset * inner[2 * units :], -1, 1)
    return candidate + update * (h - candidate), gates, candidate, inner[2 * units :]


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=0))
    return raised / raised.sum(axis=0)


def gradients(net: Network, windows: np.ndarray, targets: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all bytes of the windows (time, batch) and its gradients, by backpropagation through time."""
    length, batch = windows.shape
    units = net.state[0].shape[1]
    order = (range(length), range(length - 1, -1, -1))
    kept: list[list] = [[None] * length for _ in order]
    for way, times in enumerate(order):
        h = np.zeros((units, batch), np.float32)
        for t in times:
            new, gates, candidate, inner = step(net.input[way][:, windows[t]], net.state[way], h)
            kept[way][t] = (h, new, gates, candidate, inner)
            h = new

    grads = [np.zeros_like(p) for p in net.parameters()]
    goal = np.zeros((len(net.languages), batch), np.float32)
    goal[targets, np.arange(batch)] = 1
    loss, off = 0.0, []
    for t in range(length):
        p = softmax(net.out[0] @ kept[0][t][1] + net.out[1] @ kept[1][t][1] + net.bias)
        loss -= float(np.log(p[targets, np.arange(batch)] + 1e-9).sum())
        off.append((p - goal) / (length * batch))
        for way in range(2):
            grads[4 + way] += off[t] @ kept[way][t][1].T
        grads[6] += off[t].sum(axis=1, keepdims=True)

    once = np.eye(256, dtype=np.float32)
    for way, times in enumerate(order):
        back = np.zeros((units, batch), np.float32)
        for t in reversed(times):
            h, _, gates, candidate, inner = kept[way][t]
            back = back + net.out[way].T @ off[t]
            update, reset = gates[:units], gates[units:]
            in_candidate = back * (1 - update) * (np.abs(candidate) < 1)
            in_gates = np.concatenate([back * (h - candidate), in_candidate * inner])
            in_gates *= (gates > 0) & (gates < 1)
            grads[way] += np.concatenate([in_gates, in_candidate]) @ once[windows[t]]
            in_state = np.concatenate([in_gates, in_candidate * reset])
            grads[2 + way] += in_state @ h.T
            back = back * update + net.state[way].T @ in_state
    return loss / (length * batch), grads


def train(
    windows: np.ndarray, targets: np.ndarray, languages: list[str], *, updates: int = 300, batch: int = 192, seed: int = 7
) -> Network:
    """Adam over random batches; equal input gives an equal network. ``windows`` is (number, time) of bytes."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, rng)
    if len(languages) < 2:
        return net
    # Languages are drawn alike, however common; those with hardly a window, such as stray names, by their windows.
    share = np.bincount(targets, minlength=len(languages)).astype(float)
    chance = 1 / np.maximum(share, share.max() / RARE)[targets]
    chance /= chance.sum()
    first = [np.zeros_like(p) for p in net.parameters()]
    second = [np.zeros_like(p) for p in net.parameters()]
    for k in range(1, updates + 1):
        rows = rng.choice(len(targets), size=batch, p=chance)
        _, grads = gradients(net, windows[rows].T, targets[rows])
        rate = 0.02 * min(1.0, 2 * (1 - k / (updates + 1)))
        whole = max(1.0, float(np.sqrt(sum((g**2).sum() for g in grads))))
        for p, g, m, v in zip(net.parameters(), grads, first, second):
            g = g / whole
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(np.float32)
    return net


def read(net: Network, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The summed distributions (languages, windows) over the bytes of each window.

    ``lengths`` fall, so that the windows still running are always the first ones.
    """
    total = np.zeros((len(net.languages), len(starts)), np.float32)
    units, longest = net.state[0].shape[1], int(lengths[0])
    running = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]  # longer than t
    ahead = np.zeros((longest, units, len(starts)), np.float32)
    h = np.zeros((units, len(starts)), np.float32)
    for t in range(longest):
        n = running[t]
        given = net.input[0].take(data[starts[:n] + t], axis=1)
        h = ahead[t, :, :n] = step(given, net.state[0], h[:, :n])[0]
    h = np.zeros((units, 0), np.float32)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        if n > h.shape[1]:
            h = np.concatenate([h, np.zeros((units, n - h.shape[1]), np.float32)], axis=1)
        given = net.input[1].take(data[starts[:n] + t], axis=1)
        h = step(given, net.state[1], h)[0]
        total[:, :n] += softmax(net.out[0] @ ahead[t, :, :n] + net.out[1] @ h + net.bias)
    return total


def predict(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The mean distribution (texts, languages) over all bytes of each text; zeros for empty texts."""
    sizes = np.diff(offsets)
    number = -(-sizes // WINDOW)
    of = np.repeat(np.arange(len(sizes)), number)
    k = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
    starts = offsets[:-1][of] + k * WINDOW
    lengths = np.minimum(sizes[of] - k * WINDOW, WINDOW)
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros((len(sizes), len(net.languages)))
    for at in range(0, len(order), TOGETHER):
        rows = order[at : at + TOGETHER]
        found = read(net, data, starts[rows], lengths[rows])
        for language in range(len(net.languages)):
            out[:, language] += np.bincount(of[rows], weights=found[language], minlength=len(sizes))
    return out / np.maximum(sizes, 1)[:, None]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few windows of each text at places given by its id; a shorter text is repeated until it fills one."""
    for batch in common.slices(batches):
        texts = batch.column(TEXT).cast(pa.large_binary()).to_pylist()
        rows, langs, cut = [], [], []
        for number, lang, text in zip(batch.column(ID).to_pylist(), batch.column("lb_lang").to_pylist(), texts):
            if not text:
                continue
            text = text * -(-TRAINING_WINDOW // len(text))
            for k in range(WINDOWS_EACH):
                at = zlib.crc32(f"{number}:{k}".encode()) % (len(text) - TRAINING_WINDOW + 1)
                rows.append(number)
                langs.append(lang)
                cut.append(text[at : at + TRAINING_WINDOW])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows, pa.int64()), pa.array(langs, pa.string()), pa.array(cut, pa.binary())],
            [ID, "lb_lang", "lb_window"],
        )


def fit(
    docs: DataFrame,
    usable: Column | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    *,
    max_labelled: int = MAX_LABELLED,
    updates: int = 300,
) -> Network:
    """Train on windows of at most ``max_labelled`` labelled documents that are ``usable``.

    Each language gets an equal part of the sample, 1000 documents at most; what
    rare ones leave goes to the others. Of more than ``MAX_LANGUAGES`` values,
    the most frequent are learned (by name if equally frequent) and a warning
    tells so; texts of the others get a row too, with the nearest learned language.
    """
    named = docs.select(
        column(id_column).cast("long").alias(ID),
        common.whole_text(text_column).alias(TEXT),
        column(lang_column).cast("string").alias("lb_lang"),
    ).filter(F.col("lb_lang").isNotNull() & F.col(ID).isNotNull())
    if usable is not None:
        named = named.filter(usable)
    # Ids are counted roughly: the count only sets how many are looked at.
    counts = F.count(F.lit(1)).alias("n"), F.approx_count_distinct(ID).alias("ids")
    found = named.groupBy("lb_lang").agg(*counts).orderBy(F.desc("n"), "lb_lang")
    common_first = found.limit(MAX_LANGUAGES + 1).collect()
    learned = common_first[:MAX_LANGUAGES]
    languages = sorted(r.lb_lang for r in learned)
    if len(common_first) > MAX_LANGUAGES:
        warnings.warn(f"only the {MAX_LANGUAGES} most frequent values of {lang_column} are learned", stacklevel=2)
        named = named.filter(F.col("lb_lang").isin(languages))
    if not languages:
        return Network.fresh([], np.random.default_rng(0))
    each, left = 1, max_labelled
    for n, r in enumerate(reversed(learned)):  # the rarest first
        each = max(1, left // (len(learned) - n))
        if r.n > each:
            break
        left -= r.n
    each = min(1000, each)
    # A language's rows with small hashes, somewhat more than it needs, as its count tells: so no
    # language is gathered in a task. The exact cut is then among these few.
    share = {r.lb_lang: min(1.0, (each + 8 * math.sqrt(each) + 50) / max(1, r.ids)) for r in learned}
    least = -(1 << 63)
    bounds = small_rows(
        docs.sparkSession,
        [{"lb_lang": lang, "lb_bound": min((1 << 63) - 1, least + int(part * (1 << 64)))} for lang, part in share.items()],
        pa.schema([("lb_lang", pa.string()), ("lb_bound", pa.int64())]),
    )
    few = named.select(ID, "lb_lang").join(F.broadcast(bounds), "lb_lang").filter(F.xxhash64(ID) <= F.col("lb_bound"))
    order = Window.partitionBy("lb_lang").orderBy(F.xxhash64(ID), ID)
    chosen = (
        few.select(ID, "lb_lang").distinct().withColumn("n", F.row_number().over(order)).filter(F.col("n") <= each)
    ).select(ID, "lb_lang")
    rows = (
        named.join(F.broadcast(chosen), [ID, "lb_lang"])
        .mapInArrow(_windows, f"{ID} long, lb_lang string, lb_window binary")
        .distinct()
        .orderBy("lb_lang", ID, "lb_window")
        .limit(max_labelled * WINDOWS_EACH)  # only rows that repeat an id with other text could go beyond
        .toArrow()
        .sort_by([("lb_lang", "ascending"), (ID, "ascending"), ("lb_window", "ascending")])
    )
    if not rows.num_rows:
        return Network.fresh([], np.random.default_rng(0))
    windows = np.frombuffer(b"".join(rows.column("lb_window").to_pylist()), np.uint8).reshape(-1, TRAINING_WINDOW)
    number = {lang: i for i, lang in enumerate(languages)}
    targets = np.array([number[lang] for lang in rows.column("lb_lang").to_pylist()])
    return train(windows, targets, languages, updates=updates)


def _predicted(batches: Iterator[pa.RecordBatch], net) -> Iterator[pa.RecordBatch]:
    net = net.value
    for batch in common.slices(batches):
        data, offsets = common.byte_view(batch.column(TEXT))
        lettered = np.array([any(map(str.isalpha, t)) for t in batch.column(TEXT).to_pylist()], bool)
        if not net.languages:
            names, scores = [UNDETERMINED] * batch.num_rows, np.zeros(batch.num_rows)
        else:
            found = predict(net, data, offsets)
            best = found.argmax(axis=1)
            names = [net.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), lettered)]
            scores = np.where(lettered, np.clip(found.max(axis=1), 0, 1), 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(ID), pa.array(names, pa.string()), pa.array(scores)], [ID, "lang_pred", "score"]
        )


def language(docs: DataFrame, net: Network, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lb_id``, ``lang_pred`` and ``score`` (the text's share for it) of every row; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(net)
    return common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        partial(_predicted, net=sent), f"{ID} long, lang_pred string, score double"
    )
