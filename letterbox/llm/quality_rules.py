"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit, policies read the bits.

A NULL or empty text has no words: all measurements are zero, and the rule on
few words fails. Rows that repeat give repeated ledger rows; NULL ids are
carried through. A very long text is measured whole, in a slice of its own.
Measurements have no ties. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import common
from .common import ID, TEXT

MEASURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_marks",
]

#: Each rule's bit and when it fails. Bits are never given to another rule: old ledgers stay readable.
RULES: dict[str, tuple[int, str]] = {
    "few_words": (0, "n_words < 50"),
    "repeated_windows": (1, "100 * n_repeat_words > 50 * n_words"),
    "symbols": (2, "10 * n_symbols > n_words"),
    "duplicate_lines": (3, "2 * n_dup_lines > n_lines"),
    "long_words": (4, "word_chars > 14 * n_words"),
    "short_words": (5, "word_chars < 2 * n_words"),
    "shouting": (6, "2 * n_upper > n_letters"),
    "exclamations": (7, "5 * n_marks > n_words"),
}

#: Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, list[str]] = {
    "base": ["few_words", "repeated_windows"],
    "v1": list(RULES),
    # Short words and exclamations are for other stages to judge.
    "v2": ["few_words", "repeated_windows", "symbols", "duplicate_lines", "long_words", "shouting"],
}


def mask(policy: str) -> int:
    return sum(1 << RULES[r][0] for r in POLICIES[policy])


_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measurements of many texts at once, from their bytes."""
    n_texts = len(offsets) - 1
    inside, starts, ends = common.words(data, offsets)
    counts = common.per_text(starts, offsets)
    text_of = np.repeat(np.arange(n_texts), counts)
    # Code points: bytes that continue none.
    out = {"n_words": counts, "word_chars": common.sums(inside & ((data & 0xC0) != 0x80), offsets)}
    out["n_symbols"] = common.sums(_SYMBOL[data], offsets)
    out |= {"n_dup_lines": np.zeros(n_texts, np.int64), "n_repeat_words": np.zeros(n_texts, np.int64)}
    out["n_upper"], out["n_letters"] = common.sums(_UPPER[data], offsets), common.sums(_LETTER[data], offsets)
    out["n_marks"] = common.sums(_MARK[data], offsets)

    # Lines with a word: runs of anything but \n that hold a word's start.
    line_inside = data != 10
    line_starts, line_ends = common.runs(line_inside, offsets)
    with_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_text = np.repeat(np.arange(n_texts), common.per_text(line_starts, offsets))
    out["n_lines"] = np.bincount(line_text[with_word], minlength=n_texts)
    if len(line_starts):
        line_code, distinct = common.codes(data, line_inside, line_starts, line_ends)
        first = pd.Series((line_text * len(distinct) + line_code)[with_word]).duplicated().to_numpy()
        out["n_dup_lines"] = np.bincount(line_text[with_word][first], minlength=n_texts)

    # Windows of three words, as pairs of (pair of words, word), within one text.
    if len(starts) >= 3:
        code, distinct = common.codes(data, inside, starts, ends)
        code = code.astype(np.int64)
        pair = pd.factorize(code[:-1] * len(distinct) + code[1:])[0].astype(np.int64)
        three = pd.factorize(pair[:-1] * len(distinct) + code[2:])[0].astype(np.int64)
        whole = text_of[2:] == text_of[:-2]
        key = np.where(whole, text_of[:-2] * (three.max() + 1) + three, -1)
        group = pd.factorize(key)[0]
        repeated = (np.bincount(group)[group] > 1) & whole
        covered = np.zeros(len(starts), bool)
        for shift in range(3):
            covered[shift : len(starts) - 2 + shift] |= repeated
        out["n_repeat_words"] = np.bincount(text_of[covered], minlength=n_texts)
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches):
        found = measure(*common.byte_view(batch.column(TEXT)))
        columns = [pa.array(found[m].astype(np.int64)) for m in MEASURES]
        yield pa.RecordBatch.from_arrays([batch.column(ID), *columns], [ID, *MEASURES])


def ledger(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``lb_id``, the measurements and ``failed`` (a bit for each rule)."""
    measured = common.ids_and_texts(docs, id_column, text_column).mapInArrow(
        _measured, f"{ID} long, " + ", ".join(f"{m} long" for m in MEASURES)
    )
    failed = F.lit(0).cast("long")
    for bit, rule in RULES.values():
        failed = failed.bitwiseOR(F.when(F.expr(rule), F.lit(1 << bit)).otherwise(0).cast("long"))
    return measured.withColumn("failed", failed)


def fails(policy: str) -> Column:
    """Whether a ledger row fails the policy; the texts are not read again."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy))) != 0


def lone_rule(policy: str) -> Column:
    """The rule that alone rejects a ledger row under the policy, or NULL."""
    seen = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    return F.coalesce(*[F.when(seen == 1 << RULES[r][0], F.lit(r)) for r in POLICIES[policy]])


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: ``rule``, ``failing``, ``alone`` (rejected by it only,
    so kept without it), ``rejected`` (by the whole policy) and ``rows``.

    The ledger is counted by its bits first: at most ``2 ** len(RULES)`` rows
    go on, whatever its size.
    """
    seen = F.col("failed").bitwiseAND(F.lit(mask(policy)))
    by_bits = rows.groupBy(seen.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r][0]).alias("bit")) for r in POLICIES[policy]])
    each = by_bits.withColumn("r", F.explode(rules))
    total = lambda of: F.sum(F.when(of, F.col("n")).otherwise(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("bits").bitwiseAND(F.col("r.bit")) != 0).alias("failing"),
        total(F.col("bits") == F.col("r.bit")).alias("alone"),
        total(F.col("bits") != 0).alias("rejected"),
        F.sum("n").alias("rows"),
    )
