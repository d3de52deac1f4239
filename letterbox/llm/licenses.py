"""License scan by digest: texts in a canonical form, looked up among known ones. DataFrame functions only.

The canonical form lowers case, drops the copyright statements before the
wording, makes anything but letters and digits one space and unifies spellings
that license comparison treats as equal. Lines within the wording are kept
whatever they begin with, so the digest of a text does not depend on its
wrapping. Its SHA-256 is hash-joined to the digests of known texts, both for the
whole text and for each of its lines, as notices are a line of their own. One
digest under two names goes by the smaller one. Very long texts and lines are
taken whole.

A NULL or empty text has the digest of the empty form and matches nothing;
a text of punctuation only is the same. Rows that repeat give repeated results;
NULL ids are carried through. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import small_rows
from . import common
from .common import ID, TEXT, column
from .license_digests import DIGESTS

#: Word beginnings and what they are written as; words are parted by one space.
SPELLINGS = [
    (" licence", " license"),
    (" sub license", " sublicense"),
    (" non commercial", " noncommercial"),
    (" organis", " organiz"),
    (" authoris", " authoriz"),
    (" copyright owner", " copyright holder"),
    (" favour", " favor"),
    (" per cent", " percent"),
    (" whilst", " while"),
]

#: Known texts: fixed values of public licenses, notices first, then short licenses as a whole.
NOTICES: list[tuple[str, str]] = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("all-rights-reserved", "All rights reserved."),
]
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""
TEXTS: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
]


#: Code points of a line that may be a notice; the texts known by digest only are longer.
NOTICE = 300

#: A copyright statement: the word or the sign, followed by the sign, a year or a holder.
_SIGN = r"(?:\(c\)|©|&copy;)"
_NO_HOLDER = r"(?:notices?|holders?|owners?|licen[cs]es?|laws?|statements?|interests?|permissions?|and|or|on|in)\b"
_STATEMENT = (
    rf"[^\p{{L}}\p{{N}}\n]*(?:{_SIGN}[^\n]*[\p{{L}}\p{{N}}]"
    rf"|copyright\b[^\p{{L}}\p{{N}}\n]*(?:{_SIGN}|\p{{N}}|(?!{_NO_HOLDER})\p{{L}}))[^\n]*"
)
#: A license's name on a line of its own. Those of GNU's licenses end the block: their own statement is part of the text.
_TITLE = rf"(?!{_STATEMENT})(?![^\n]*(?:gnu|general public))[^\n]{{0,60}}licen[cs]e[^\n]{{0,30}}\n"
#: From where the last statement ended: blank lines and titles, then the next statement.
_LEADING = rf"\G([^\p{{L}}\p{{N}}]*\n(?:{_TITLE}(?:[^\p{{L}}\p{{N}}]*\n)?){{0,3}}){_STATEMENT}"


def canonical(text: Column) -> Column:
    """The canonical form, lines still apart: each line's words with a space before each, lines parted by " \\n"."""
    lowered = F.concat(F.lit("\n"), F.lower(text))
    bare = F.regexp_replace(lowered, _LEADING, "$1")
    spaced = F.regexp_replace(bare, r"[^\p{L}\p{N}\n]+", " ")
    apart = F.replace(spaced, F.lit("\n"), F.lit(" \n "))
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), SPELLINGS, apart)


def _words(form: Column) -> Column:
    words = F.regexp_replace(form, r"[ \n]+", " ")
    # Spellings of two words, which a line break may have parted.
    parted = [pair for pair in SPELLINGS if " " in pair[0].strip()]
    return reduce(lambda t, pair: F.replace(t, F.lit(pair[0]), F.lit(pair[1])), parted, words)


def _digest(form: Column) -> Column:
    return F.sha2(F.trim(_words(form)).cast("binary"), 256)


def whole_digest(form: Column) -> Column:
    return _digest(form)


def catalog(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """``digest``, ``license``, ``size`` (code points of the form, if known) of the known texts: a list of code.

    Without ``known`` these are the notices, the texts, and the texts of which only the digests are kept here.
    """
    kept = [(name, digest) for name, digests in DIGESTS.items() for digest in digests] if known is None else []
    known = NOTICES + TEXTS if known is None else known
    schema = pa.schema([("license", pa.string()), ("text", pa.string())])
    rows = small_rows(spark, [{"license": n, "text": t} for n, t in known], schema)
    schema = pa.schema([("digest", pa.string()), ("license", pa.string())])
    fixed = small_rows(spark, [{"digest": d, "license": n} for n, d in kept], schema)
    form = canonical(F.col("text"))
    return (
        rows.select(_digest(form).alias("digest"), "license", F.length(F.trim(_words(form))).alias("size"))
        .unionByName(fixed.withColumn("size", F.lit(None).cast("int")))
        .groupBy("digest")
        .agg(F.min("license").alias("license"), F.max("size").alias("size"))
    )


def _looked_up(known: list, line: Column) -> Column:
    if not known:
        return F.lit(None).cast("string")
    entries = F.map_from_entries(F.array(*[F.struct(F.lit(r.digest), F.lit(r.license)) for r in known]))
    return F.element_at(entries, F.sha2(line.cast("binary"), 256))


def license_scan(
    docs: DataFrame,
    known: list[tuple[str, str]] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``lb_id``, ``text_digest``, ``license`` (of the
    whole text, NULL for none), ``line_licenses`` (of its lines, sorted, each once)
    and ``license_lines`` (how many lines match).

    No text is shuffled: whole texts join the broadcast digests, and each row
    looks its lines up in the same digests.
    """
    spark = docs.sparkSession
    found = catalog(spark, known)
    known_texts = found.collect()
    notices = [r for r in known_texts if r.size is not None and r.size <= NOTICE]
    longest = max((r.size for r in notices), default=-1)
    formed = common.ids_and_texts(docs, id_column, text_column).select(ID, canonical(F.col(TEXT)).alias("lb_form"))
    # A line's own form has single spaces already, but for its ends.
    lines = F.split("lb_form", "\n")
    matched = F.filter(
        F.transform(
            F.transform(lines, lambda line: F.trim(line)),
            # Most lines are too long for a notice and too short for a text, and are not hashed.
            lambda line: F.when(F.length(line) <= longest, _looked_up(notices, line)).when(
                F.length(line) > NOTICE, _looked_up([r for r in known_texts if r not in notices], line)
            ),
        ),
        lambda name: name.isNotNull(),
    )
    scanned = formed.select(ID, _digest(F.col("lb_form")).alias("text_digest"), matched.alias("lb_matched"))
    return scanned.join(
        F.broadcast(found.select(F.col("digest").alias("text_digest"), "license")), "text_digest", "left"
    ).select(
        ID,
        "text_digest",
        "license",
        F.array_sort(F.array_distinct("lb_matched")).alias("line_licenses"),
        F.size("lb_matched").cast("long").alias("license_lines"),
    )
