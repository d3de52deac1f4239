"""The registered queries and the pipeline over the smallest tables."""

from __future__ import annotations

import importlib.util
import math
import os
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from letterbox.llm import mixing, token_counts  # noqa: E402
from letterbox.llm.common import saved  # noqa: E402
from letterbox.llm.queries import ORACLES, QUERIES, fit_quality, table, vocabulary  # noqa: E402

from ..test_queries import normal  # noqa: E402
from .test_dedup import brute_components, brute_mark, same  # noqa: E402
from .test_mixing import brute_passes  # noqa: E402
from .test_models import brute_score  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    answer, expected = QUERIES[name](spark, SF_DIR).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(answer.columns) == sorted(expected.columns)
    assert normal(answer) == normal(expected)


def test_queries_have_the_agreed_columns(spark):
    agreed = {
        "op2": "doc_id bigint, held_out boolean, score double, predicted int",
        "op3": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op4": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean",
        "op6": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
        "op7": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
        "op8": "doc_id bigint, held_out boolean, score double, predicted int",
        "op9": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        "op10": "doc_id bigint, fingerprint string, component_id bigint",
        "op11": "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string",
        "op12": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
        "cost bigint, audit string, repaired_sha256 string",
        "op13": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    }
    for name, query in QUERIES.items():
        columns = dict(query(spark, SF_DIR).dtypes)
        for column in agreed.get(name.split("_")[0], "doc_id bigint").split(", "):
            assert columns[column.split()[0]] == column.split()[1], (name, column)
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_near_duplicates_of_the_table_equal_brute_force(spark):
    docs = sorted((r.doc_id, r.text) for r in table(spark, SF_DIR, "documents").collect())
    marks = [brute_mark(t) for _, t in docs]
    expected = {i: (f"{m:016x}", docs[r][0]) for (i, _), m, r in zip(docs, marks, brute_components(marks))}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op10_simhash"](spark, SF_DIR).collect()}
    assert found == expected


def test_pipeline_equals_brute_force(spark):
    """Stage by stage, each on its own input."""
    docs = table(spark, SF_DIR, "documents")
    rows = [tuple(r) for r in docs.collect()]
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF_DIR), "stage")
        outputs.append([tuple(r) for r in docs.collect()])

    model = fit_quality(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    scores = {r[0]: brute_score(model, r[1]) for r in rows}
    certain = {i for i, s in scores.items() if abs(s - 0.3) > 1e-3}
    assert {r[0] for r in outputs[0]} & certain == {i for i in certain if scores[i] >= 0.3}

    first = {}
    for r in sorted(outputs[0]):
        first.setdefault(same(r[1]), r)
    assert sorted(outputs[1]) == sorted(first.values())

    ordered = sorted(outputs[1])
    roots = brute_components([brute_mark(r[1]) for r in ordered])
    assert sorted(outputs[2]) == [ordered[i] for i in sorted(set(roots))]

    mix = mixing.Mix(entropy=0.999, max_passes=2.0)
    times = Counter(i for i, *_ in brute_passes([r[:4] for r in outputs[2]], mix))
    assert Counter(r[0] for r in outputs[3]) == times
    assert set(outputs[3]) == set(outputs[2])

    encoder = token_counts.encoder(vocabulary())
    pieces = Counter()
    for r in outputs[3]:
        size = len(encoder.whole.encode(r[1] or "", add_special_tokens=False).ids) + 1
        for at in range(0, size, 4096):
            pieces[(r[0], at // 4096, at, min(4096, size - at))] += 1
    packed = [r.asDict() for r in docs.collect()]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in packed) == pieces
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:])) and parts[0][0] == 0
        assert sum(n for _, n in parts) <= 4096
    assert len(sequences) <= math.ceil(sum(r["length"] for r in packed) / 4096) + 1


def test_run_applies_all_stages(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "SimHash near-dedup", "source mixing", "best-fit packing"
    ]


def test_the_pipeline_takes_odd_documents(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = saved(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == odd.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()
    assert {r.doc_id for r in docs.collect()} >= {5}


def test_operators_stand_alone_and_the_rest_without_them(tmp_path):
    root = Path(corpus_pipeline.__file__).parent
    for module in (root / "letterbox").rglob("*.py"):
        if "llm" not in module.relative_to(root).parts:
            assert "llm" not in module.read_text(), module
    copy = tmp_path / "repo"
    (copy / "letterbox").mkdir(parents=True)
    for path in (root / "letterbox").iterdir():
        if path.name not in ("llm", "__pycache__"):
            (copy / "letterbox" / path.name).symlink_to(path)
    (copy / "__spark_entry__.py").write_text((root / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)})
    assert said.stdout.split() == [said.stdout.split()[0], "False"], said.stderr
    assert importlib.util.find_spec("letterbox.llm.queries")


