"""Spelling variants by finite-state composition: acceptor, one-edit transducer, acceptor.

The words are counted by Spark. Two words are near if they differ by exactly one
inserted, deleted or replaced code point. For words of at least four code
points the edit lies in the first half or the second, so near words share the
other half: each half is an initial state, and the words behind it a partition.
A partition's words become a minimised acceptor, whose composition with the
one-edit transducer and itself is walked; each pair of near words is accepted
in one partition, at one place. A partition of too many or too long words is split again
by halves of what its words don't share, until an edit has one place left.

NULL and empty texts have no words, a NULL id counts as empty text. Rows that
repeat an id and a text count again, as do equal words of a text. Very long texts
and words are taken whole. Of near words with equal counts the smallest by code
points is the form. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common
from .common import ID, TEXT

#: Words of a partition worked on at once; a larger one is split by the halves of its open part.
PARTITION_WORDS = 20_000
#: Code points that the words of a partition don't share at most; longer ones are split in the same way.
OPEN_LENGTH = 64

# The letters of words, and those that are lowered.
_LETTERS = "([A-Za-zÀ-ÿ]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    *,
    least_length: int = 6,
    least_count: int = 5,
    modulus: int = 199,
) -> DataFrame:
    """``word``, ``n`` of all words frequent and long enough.

    A run whose crc32 of ``id:run`` the modulus divides loses the code point
    that the crc picks. Tasks add up before the shuffle, so frequent words cost
    a row a task.
    """
    texts = common.ids_and_texts(docs, id_column, text_column)
    # A run can only get shorter.
    long = F.filter(F.regexp_extract_all(TEXT, F.lit(_LETTERS), F.lit(1)), lambda r: F.length(r) >= least_length)
    name = F.coalesce(F.col(ID).cast("string"), F.lit(""))
    run = F.col("lb_run")
    lowered = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, _UPPER, _LOWER))
    runs = texts.select(name.alias("lb_name"), F.explode(long).alias("lb_run")).select("lb_name", lowered.alias("lb_run"))
    crc = F.crc32(F.concat("lb_name", F.lit(":"), "lb_run").cast("binary"))
    hashed = runs.select("lb_run", crc.alias("lb_crc"))
    place = (F.col("lb_crc") % F.length("lb_run")).cast("int")
    cut = F.concat(
        F.substring("lb_run", F.lit(1), place), F.substring("lb_run", place + 2, F.length("lb_run"))
    )
    word = F.when(F.col("lb_crc") % modulus == 0, cut).otherwise(F.col("lb_run"))
    return (
        hashed.select(word.alias("word"))
        .filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_count)
    )


# Partitions -----------------------------------------------------------------------------
#
# A partition holds words of ``lb_size`` and ``lb_size + 1`` code points that share their first
# ``lb_left`` and last ``lb_right`` ones. Its pairs are of a word of the smaller size and another
# word, and have their first difference before ``lb_until``.


def _halves(words: DataFrame) -> DataFrame:
    """Each word in the two halves of its open part: the rest of a pair shares one of them."""
    open_part = F.col("lb_size") - F.col("lb_left") - F.col("lb_right")
    first = F.floor(open_part / 2).cast("int")
    left = F.struct(
        (F.col("lb_left") + first).alias("lb_left"), F.col("lb_right"), F.col("lb_until")
    )
    right = F.struct(
        F.col("lb_left"),
        (F.col("lb_right") + open_part - first).alias("lb_right"),
        # Pairs whose first difference comes later share the first half and are found there.
        F.least(F.col("lb_until"), F.col("lb_left") + first).alias("lb_until"),
    )
    return words.select("word", "n", "lb_size", F.explode(F.array(left, right)).alias("lb_half")).select(
        "word", "n", "lb_size", "lb_half.*", _key().alias("lb_key")
    )


def _key() -> Column:
    at = lambda name: F.col(f"lb_half.{name}")
    length = F.length("word")
    return F.concat_ws(
        "/",
        F.col("lb_size"),
        at("lb_left"),
        at("lb_right"),
        at("lb_until"),
        F.substring("word", F.lit(1), at("lb_left")),
        F.substring("word", length - at("lb_right") + 1, at("lb_right")),
    )


def partitions(words: DataFrame, most: int | None = None) -> DataFrame:
    """The words of ``word``, ``n`` dealt to partitions of at most ``most`` words
    and ``OPEN_LENGTH`` open code points, or of one open code point, whose words
    differ in one or two letters. Partitions of one word are left out."""
    most = most or PARTITION_WORDS
    length = F.length("word")
    sized = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("lb_size"))
    whole = sized.withColumns(
        {"lb_left": F.lit(0), "lb_right": F.lit(0), "lb_until": F.lit(2**31 - 1)}
    )
    level = common.saved(_halves(whole), "spelling")
    done = []
    while True:
        sizes = level.groupBy("lb_key").agg(
            F.count(F.lit(1)).alias("lb_words"), F.max(F.col("lb_size") - F.col("lb_left") - F.col("lb_right")).alias("lb_open")
        )
        large = ((F.col("lb_words") > most) | (F.col("lb_open") > OPEN_LENGTH)) & (F.col("lb_open") > 1)
        groups = common.saved(sizes.filter("lb_words > 1"), "spelling-sizes")
        crowded = common.saved(groups.filter(large), "spelling-large")
        if crowded.isEmpty():
            return _union([*done, level.join(groups.select("lb_key"), "lb_key", "left_semi")])
        done.append(level.join(groups.filter(~large).select("lb_key"), "lb_key", "left_semi"))
        # All of a crowded partition goes on; it is dealt by word, not by partition.
        rest = common.attach(level, crowded, "lb_key", "lb_words")
        level = common.saved(_halves(rest.select("word", "n", "lb_size", "lb_left", "lb_right", "lb_until")), "spelling")


def _union(frames: list[DataFrame]) -> DataFrame:
    names = ["word", "n", "lb_size", "lb_left", "lb_right", "lb_until", "lb_key"]
    found = frames[0].select(names)
    for frame in frames[1:]:
        found = found.unionByName(frame.select(names))
    return found


# Composition ----------------------------------------------------------------------------


class Acceptor:
    """The minimised acceptor of sorted words: a state for each distinct set of endings."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self.start = self._state(words, 0, len(words), 0)

    def _state(self, words: list[str], low: int, high: int, depth: int) -> int:
        final = len(words[low]) == depth
        low += final
        arcs = []
        while low < high:
            letter, stop = words[low][depth], low + 1
            while stop < high and words[stop][depth] == letter:
                stop += 1
            arcs.append((letter, self._state(words, low, stop, depth + 1)))
            low = stop
        key = (final, *arcs)
        if key not in self._known:
            self._known[key] = len(self.arcs)
            self.arcs.append(dict(arcs))
            self.final.append(final)
        return self._known[key]


class Composition:
    """Acceptor, one-edit transducer, acceptor: pairs of words one replaced or inserted code point apart.

    Before the edit both tapes are in the same state; behind it the endings that
    both states accept are the same on either tape, and are worked out once for
    each pair of states.
    """

    def __init__(self, acceptor: Acceptor):
        self.acceptor = acceptor
        self._endings: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def endings(self, a: int, b: int) -> list[str]:
        """What both states accept."""
        if a > b:
            a, b = b, a
        found = self._endings.get((a, b))
        if found is None:
            arcs, other = self.acceptor.arcs[a], self.acceptor.arcs[b]
            found = [""] if self.acceptor.final[a] and self.acceptor.final[b] else []
            for letter, to in arcs.items():
                if letter in other:
                    found += [letter + rest for rest in self.endings(to, other[letter])]
            self._endings[(a, b)] = found
        return found

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs of endings from a state whose edit is here: replaced both ways, inserted on the second."""
        found = self._edits.get(state)
        if found is None:
            found, arcs = [], list(self.acceptor.arcs[state].items())
            for i, (letter, to) in enumerate(arcs):
                for other, there in arcs[:i]:
                    for rest in self.endings(to, there):
                        found += [(letter + rest, other + rest), (other + rest, letter + rest)]
                # Where the next code point equals the inserted one, the insertion counts further on.
                found += [(rest, letter + rest) for rest in self.endings(state, to) if rest[:1] != letter]
            self._edits[state] = found
        return found

    def pairs(self, until: int) -> Iterator[tuple[str, str]]:
        """All pairs whose first difference comes before ``until``."""
        path = [(self.acceptor.start, "")]
        while path:
            state, prefix = path.pop()
            if len(prefix) >= until:
                continue
            for first, second in self.edits(state):
                yield prefix + first, prefix + second
            path += [(to, prefix + letter) for letter, to in self.acceptor.arcs[state].items()]


def near_words(words: dict[str, int], size: int, left: int, right: int, until: int) -> Iterator[tuple[str, str]]:
    """The near pairs of a partition: a word of ``size`` code points first."""
    one = next(iter(words))
    share, end = one[:left], one[len(one) - right :]
    opened = sorted(w[left : len(w) - right] for w in words)
    short = size - left - right
    for first, second in Composition(Acceptor(opened)).pairs(until - left):
        if len(first) == short:
            yield share + first + end, share + second + end


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, rows in groupby(_rows(batches), key=lambda r: r[-1]):
        rows = list(rows)
        words = {r[0]: r[1] for r in rows}
        _, _, size, left, right, until, _ = rows[0]
        found = ([], [], [])
        for a, b in near_words(words, size, left, right, until):
            # A replacement is met both ways round, an insertion once.
            for word, other in ((a, b), (b, a)) if len(a) != len(b) else ((a, b),):
                found[0].append(word)
                found[1].append(other)
                found[2].append(words[other])
            if len(found[0]) >= 50_000:
                yield _batch(found)
                found = ([], [], [])
        if found[0]:
            yield _batch(found)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _batch(found: tuple[list, list, list]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["word", "other", "other_n"])


def near(words: DataFrame, most: int | None = None) -> DataFrame:
    """``word``, ``other``, ``other_n``: each pair of near words, both ways round, once."""
    dealt = partitions(words, most).repartition("lb_key").sortWithinPartitions("lb_key")
    return dealt.select("word", "n", "lb_size", "lb_left", "lb_right", "lb_until", "lb_key").mapInArrow(
        _near, "word string, other string, other_n long"
    )


def variants(words: DataFrame, ratio: int = 5, most: int | None = None) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of ``word``, ``n``.

    The form is the most frequent near word, if it has ``ratio`` times the
    count. Counts grow along forms, so these end; roots are found in doubling steps.
    """
    words = common.saved(words.select("word", "n"), "words")
    first = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other"))).alias("lb_best")
    found = near(words, most).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), first)
    best_n = -F.col("lb_best.less")
    takes = best_n >= ratio * F.col("n")
    joined = common.saved(
        words.join(found, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(takes, F.col("lb_best.other")).alias("form"),
            F.when(takes, best_n).alias("form_n"),
        ),
        "forms",
    )
    step = common.saved(joined.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = common.saved(
            step.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        step = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            break
    return joined.join(step, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
