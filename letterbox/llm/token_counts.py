"""Token counts and ids of a public word-level BPE, whole tokens first, merges only for the rest.

The vocabulary's strings that encode alone as one token are found offline, once,
by asking the tokenizer itself. A text is cut into pre-tokens by array
operations over its bytes; distinct pre-tokens found in that table count
directly, and only the others are merged by the tokenizer, each once per worker.

The cut knows the characters up to U+07FF (Latin, Greek, Cyrillic, Armenian,
Hebrew, Arabic and more), whose lower case, class and normal form are asked of
the tokenizer as well. White space parts what is normalised, cut and merged, so
any other character, such as a curly quote or a combining mark, concerns its
run without white space only: the run counts directly if it is proved to be one
token, and goes to the tokenizer else, once per worker if it is short. A text
with a special token's string goes to the tokenizer whole. All ways give the
same tokens. A NULL text counts as empty and has no tokens; rows that repeat
give repeated results; an empty table gives an empty result; a very long text is
a slice of its own, and its long runs are not remembered.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common
from .common import ID, TEXT

#: Pre-tokens remembered by a worker; beyond that it starts anew, with the same results.
REMEMBERED = 250_000
#: Bytes of the longest run that is remembered.
LONGEST = 256

# Classes of characters. OTHER is anything that is not white space, letter or digit.
UNKNOWN, SPACE, LETTER, DIGIT, OTHER = range(5)
_TOP = 0x800
_QUOTE = ord("'")
#: Fixed values of the vocabulary's pattern: what stays with an apostrophe.
_TAILS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


class WordEncoder:
    """The tokenizer of one vocabulary file with its tables. One is kept per worker."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.specials = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self._classify()
        self._prove()
        # A pre-token's ids as little-endian 32-bit numbers.
        self.known: dict[bytes, bytes] = {}

    def _classify(self) -> None:
        """Class and lower case of each character, as the tokenizer's own steps have them."""
        normal, cut = self.whole.normalizer.normalize_str, self.whole.pre_tokenizer.pre_tokenize_str
        self.kind = np.zeros(_TOP, np.uint8)
        self.lower = np.arange(_TOP)
        for point in range(_TOP):
            char = chr(point)
            if unicodedata.combining(char):  # joins the character before it
                continue
            low = normal(char)
            if len(low) != 1 or (ord(low) > 127) != (point > 127) or ord(low) >= _TOP:
                if not (point < 128 and low == " "):
                    continue
            n = len(cut(normal(f"a{char}a")))
            doubled = len(cut(normal(f"a{char}{char}a")))
            self.kind[point] = {(2, 2): SPACE, (1, 1): LETTER, (3, 4): DIGIT, (3, 3): OTHER}.get((n, doubled), UNKNOWN)
            self.lower[point] = ord(low)
        known = "".join(re.escape(chr(point)) for point in np.flatnonzero(self.kind).tolist())
        self.plain = re.compile(f"[{known}]*").fullmatch

    def _prove(self) -> None:
        """Which vocabulary strings, written alone, are that one token."""
        written = {v: k for k, v in _byte_letters().items()}
        end = "</w>"
        texts, ids = [], []
        for token, number in self.whole.get_vocab(with_added_tokens=False).items():
            if token.endswith(end) and len(token) > len(end):
                raw = bytes(written[c] for c in token[: -len(end)])
                try:
                    texts.append(raw.decode())
                    ids.append(number)
                except UnicodeDecodeError:
                    pass  # half a character stands for no text
        self.single = {}
        for at in range(0, len(texts), 1000):  # an encoding holds far more than its ids
            encoded = self.whole.encode_batch_fast(texts[at : at + 1000], add_special_tokens=False)
            for text, number, found in zip(texts[at:], ids[at:], encoded):
                if found.ids == [number]:
                    self.single[text.encode()] = number.to_bytes(4, "little")
        self.closes = np.zeros(self.whole.get_vocab_size(), bool)
        self.closes[[i for token, i in self.whole.get_vocab().items() if token.endswith(end)]] = True

    def pre_tokens(self, data: np.ndarray, offsets: np.ndarray):
        """Lowered bytes, which of them count, starts and ends of the pre-tokens.

        A run without white space that holds an unknown character is one piece, as it was written.
        """
        n = len(data)
        point = data.astype(np.int16)
        lead = (data & 0xE0) == 0xC0
        at = np.flatnonzero(lead[:-1]) if n else np.zeros(0, np.int64)
        pair = ((data[at].astype(np.int16) & 0x1F) << 6) | (data[at + 1] & 0x3F)
        low_pair = pair < _TOP
        kind = np.zeros(n, np.uint8)
        single = data < 128
        kind[single] = self.kind[data[single]]
        known = np.where(low_pair, self.kind[np.where(low_pair, pair, 0)], UNKNOWN)
        kind[at], kind[at + 1] = known, known
        low = np.where(single, self.lower[np.where(single, point, 0)], data).astype(np.uint8)
        lowered = self.lower[np.where(low_pair, pair, 0)]
        low[at] = np.where(known > 0, 0xC0 | (lowered >> 6), data[at])
        low[at + 1] = np.where(known > 0, 0x80 | (lowered & 0x3F), data[at + 1])

        inside = kind != SPACE
        # A pre-token starts where the class changes, at every digit and at every text.
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        change = np.ones(n, bool)
        change[1:] = kind[1:] != kind[:-1]
        follower = (data & 0xC0) == 0x80
        first[:n] |= change | ((kind == DIGIT) & ~follower)
        first[:n] &= inside | first[:n]
        for start, length in self._contractions(low, kind, first, offsets):
            first[start + 1 : start + length] = False
            first[start + length] = True
        if n and not kind.all():
            begins = inside.copy()
            begins[1:] &= ~inside[:-1]
            begins[offsets[:-1][np.diff(offsets) > 0]] = True
            run = np.cumsum(begins, dtype=np.int32)
            strange = np.zeros(run[-1] + 1, bool)
            strange[run[kind == UNKNOWN]] = True
            whole = inside & strange[run]
            first[:n][whole] = begins[whole]
            low = np.where(whole, data, low)
        boundary = np.flatnonzero(first)
        starts, ends = boundary[:-1], boundary[1:]
        real = inside[starts] if len(starts) else np.zeros(0, bool)
        return low, inside, starts[real], ends[real]

    def _contractions(self, low, kind, first, offsets) -> Iterator[tuple[int, int]]:
        """Apostrophes that start a match and the length of the match with its letters."""
        marks = np.flatnonzero(first[:-1] & (low == _QUOTE))
        marks = marks[: len(marks)]
        limits = offsets[np.searchsorted(offsets, marks, "right")] if len(marks) else marks
        for mark, limit in zip(marks.tolist(), limits.tolist()):
            yield from self._chain(low, mark, limit)

    @staticmethod
    def _chain(low, mark, limit) -> Iterator[tuple[int, int]]:
        """The contraction at an apostrophe and those that follow it directly."""
        while mark < limit and low[mark] == _QUOTE:
            after = low[mark + 1 : min(mark + 3, limit)].tobytes()
            tail = next((t for t in _TAILS if after.startswith(t)), None)
            if tail is None:
                return
            yield mark, 1 + len(tail)
            mark += 1 + len(tail)

    def ids_of(self, distinct: list[bytes]) -> list[bytes]:
        """The ids of each pre-token: whole tokens by the table, the rest by merging, once."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, found = self.known, list(map(self.single.get, distinct))
        missing = [i for i, ids in enumerate(found) if ids is None]
        rest = [w for w in (distinct[i] for i in missing) if w not in known]
        plain = [w for w in rest if self.plain(w.decode())]
        fresh = dict(zip(plain, self._merged(plain)))
        if len(plain) < len(rest):
            strange = [w for w in rest if w not in fresh]
            fresh.update(zip(strange, self._cut_and_merged(strange)))
        for i in missing:
            ids = known.get(distinct[i])
            found[i] = fresh[distinct[i]] if ids is None else ids
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONGEST)
        return found

    def _merged(self, rest: list[bytes]) -> Iterator[bytes]:
        """Spaces part pre-tokens, and each one's last token closes a word."""
        for at in range(0, len(rest), 10_000):
            text = b" ".join(rest[at : at + 10_000]).decode()
            ids = np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) != len(rest[at : at + 10_000]):
                raise ValueError("the vocabulary doesn't close every pre-token with an end-of-word token")
            start = 0
            for end in ends:
                yield ids[start:end].tobytes()
                start = end

    def _cut_and_merged(self, runs: list[bytes]) -> Iterator[bytes]:
        """Runs that the tokenizer has to cut as well; an encoding holds far more than its ids, so few at once."""
        at = 0
        while at < len(runs):
            upto, size = at + 1, len(runs[at])
            while upto < len(runs) and size + len(runs[upto]) <= 16_384:
                size += len(runs[upto])
                upto += 1
            texts = [r.decode() for r in runs[at:upto]]
            for found in self.whole.encode_batch_fast(texts, add_special_tokens=False):
                yield np.array(found.ids, "<u4").tobytes()
            at = upto

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin (one more: the end)."""
        coded, lengths, per_word, firsts, counts, strange = self._words(texts)
        flat = np.frombuffer(b"".join(per_word), "<u4")
        n_ids = lengths[coded]
        total = np.zeros(len(n_ids) + 1, np.int64)
        np.cumsum(n_ids, out=total[1:])
        places = np.repeat(firsts[coded] - total[:-1], n_ids) + np.arange(total[-1])
        ids = flat[places]
        text_ends = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=text_ends[1:])
        offsets = total[text_ends]
        if not strange:
            return ids, offsets
        parts, sizes = [], np.diff(offsets)
        for i in range(len(counts)):
            own = strange.get(i)
            parts.append(ids[offsets[i] : offsets[i + 1]] if own is None else own)
            sizes[i] = len(parts[-1])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])

    def count(self, texts: pa.Array) -> np.ndarray:
        """The number of tokens of each text."""
        coded, lengths, _, _, counts, strange = self._words(texts)
        text_ends = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=text_ends[1:])
        found = common.sums(lengths[coded], text_ends)
        for i, own in strange.items():
            found[i] = len(own)
        return found

    def _words(self, texts: pa.Array):
        data, offsets = common.byte_view(texts)
        low, inside, starts, ends = self.pre_tokens(data, offsets)
        odd = self._has_special(data, offsets)
        strange = {}
        if odd.any():
            numbers = np.flatnonzero(odd)
            raw = [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in numbers]
            for i, text in zip(numbers.tolist(), raw):  # one by one: an encoding holds far more than its ids
                strange[i] = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            own = odd[np.searchsorted(offsets, starts, "right") - 1]
            starts, ends = starts[~own], ends[~own]
            inside = np.zeros(len(data) + 1, np.int8)
            np.add.at(inside, starts, 1)
            np.add.at(inside, ends, -1)
            inside = np.cumsum(inside[:-1]) > 0
        coded, distinct = common.codes(low, inside, starts, ends)
        per_word = self.ids_of(distinct.to_pylist())
        lengths = np.fromiter(map(len, per_word), np.int64, len(per_word)) // 4
        firsts = np.cumsum(lengths) - lengths
        return coded, lengths, per_word, firsts, common.per_text(starts, offsets), strange

    def _has_special(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which texts hold a special token's string."""
        found = np.zeros(len(offsets) - 1, bool)
        whole = data.tobytes()
        for special in self.specials:
            at = whole.find(special)
            while at >= 0:
                found[np.searchsorted(offsets, at, "right") - 1] = True
                at = whole.find(special, at + 1)
        return found


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _counts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        texts = batch.column(TEXT)
        lengths = np.diff(common.byte_view(texts)[1])
        yield pa.RecordBatch.from_arrays(
            [batch.column(ID), pa.array(lengths), pa.array(encoder(path).count(texts))], [ID, "n_bytes", "n_tokens"]
        )


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``lb_id``, ``n_bytes`` and ``n_tokens`` of every row's whole text.

    ``path`` is the vocabulary file, at the same place on every worker.
    """
    return common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        partial(_counts, path=path), f"{ID} long, n_bytes long, n_tokens long"
    )
