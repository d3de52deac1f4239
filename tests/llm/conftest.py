from __future__ import annotations

import re

import pytest
from pyspark.sql import DataFrame

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
#: Names that operators use inside or return.
CLASHING = "lb_id string, lb_text string, score double, kept boolean, length long, component long, ids int"
EXTRA = ("x", "y", 0.5, None, 7, None, 3)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (doc_id, text[, lang, source]) with the columns of documents and clashing extra ones."""

    def build(rows) -> DataFrame:
        full = [(*r, *(None,) * (4 - len(r))) for r in rows]
        data = [(i, t, lang, source, None if t is None else len(t), *EXTRA) for i, t, lang, source in full]
        schema = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
        return spark.createDataFrame(data, schema).repartition(3)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """NULLs in every column, empty, blank and very long texts, repeated rows, a repeated id with another text."""
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
    return documents(
        [
            (1, "the first text of all", "en", "a"),
            (2, None, "en", "a"),
            (3, "", None, "b"),
            (None, "a text without an id", "en", None),
            (4, " \t\n ", "de", "b"),
            (5, long, "en", "a"),
            (6, "the  first\ttext of all", "en", "b"),
            (7, "éa ß ñ Über 9²", "de", "a"),
            (7, "éa ß ñ Über 9²", "de", "a"),
            (7, "seven again with another text", "de", "a"),
            (None, None, None, None),
            (8, "!!! --- ???", "fr", "c"),
        ]
    )


@pytest.fixture(scope="session")
def none(documents):
    return documents([(1, "x")]).limit(0)
