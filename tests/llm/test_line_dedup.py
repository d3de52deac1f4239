from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from letterbox.llm import line_dedup
from letterbox.llm.common import ID, TEXT
from letterbox.session import new_folder

SPACE = " \t\n\v\f\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(SPACE))


def brute(rows, least_documents=3):
    """One tuple per row: id, lines, dropped, kept text."""
    held = defaultdict(set)
    for r, (i, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add((r, -1 if i is None else i))
    goes = {k: max(i for _, i in at) for k, at in held.items() if len(at) >= least_documents}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if goes.get(key(x), None) in (None, -1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(docs, **settings):
    rows = line_dedup.drop_repeated_lines(docs, **settings).collect()
    return sorted(((r.lb_row.doc_id, r.n_lines, r.n_dropped, r.lb_row.text or "") for r in rows), key=repr)


def shared_rows(seed, number):
    rng = random.Random(seed)
    pool = [f"{'É' if i % 3 else 'A'} line that many documents hold, number {i}" for i in range(30)]
    rows = []
    for i in range(number):
        lines = [f"its own line in document {i} at {j}" for j in range(rng.randrange(3))]
        lines += [rng.choice(pool) for _ in range(rng.randrange(6))]
        lines += ["the hottest line of all the documents"] * (i % 3 == 0)
        lines += ["short", "", "  The HOTTEST line of all the documents\t"] * rng.randrange(2)
        rng.shuffle(lines)
        rows.append((i * 7 + 1, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("batches", [1, 3, 9])
def test_dropped_lines_equal_brute_force_however_many_batches(documents, batches):
    rows = shared_rows(4, 200)
    assert found(documents(rows), batches=batches) == brute(rows)


def test_odd_rows(odd, documents):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == brute(rows)
    kept = line_dedup.drop_repeated_lines(odd).select("lb_row.*")
    assert kept.columns == odd.columns
    line = "a line of more than twenty code points"
    many = [(None, line), (None, line + "\nx"), (None, line), (9, None), (9, line.upper()), (9, "\n\n" + line)]
    assert found(documents(many)) == brute(many)  # the largest id keeps it in each of its rows
    assert found(documents(many[:3])) == brute(many[:3])  # only NULL ids: all keep it


def test_keys_of_twenty_code_points_count_and_case_beyond_ascii_matters(documents):
    rows = [(i, t) for i, t in enumerate(["é" * 20, "é" * 20, "é" * 20, "É" * 20, "x" * 19, "x" * 19, "x" * 19, "X" * 20])]
    assert found(documents(rows)) == brute(rows)
    assert [n for _, _, n, _ in found(documents(rows))] == [1, 1, 0, 0, 0, 0, 0, 0]


def test_a_very_long_text_and_many_repeats_of_one_row(documents):
    long = "\n".join(f"line {i % 5000} of a very long text it is" for i in range(40_000))
    rows = [(1, long), (2, long), (3, long), (3, long)] + [(4, "many times the same line again")] * 300
    assert found(documents(rows)) == brute(rows)


def test_empty_table(none):
    assert line_dedup.drop_repeated_lines(none).count() == 0


def test_documents_of_a_later_call_meet_the_runs_of_earlier_ones(spark, documents):
    path, rows = new_folder(spark, "runs"), shared_rows(8, 120)
    halves = rows[:60], rows[60:]
    for part in halves:
        runs = line_dedup.LineRuns(spark, path)  # opened anew, as by another session
        known = line_dedup.repeated(documents(part), batches=2, runs=runs)
        runs.close()
    whole = line_dedup.repeated(documents(rows))
    last = {bytes(r.lb_key): r.lb_last for r in known.collect()}
    assert last == {bytes(r.lb_key): r.lb_last for r in whole.collect()} and last


def hashes(spark, keys, last):
    rows = spark.createDataFrame([(bytes([k]) * 16, n, last) for k, n in keys], "lb_key binary, lb_docs long, lb_last long")
    return rows


def test_runs_are_levelled_and_settled_hashes_left_out(spark):
    runs = line_dedup.LineRuns(spark, new_folder(spark, "runs"), buckets=3)
    spans = []
    for batch in range(5):
        runs.add(hashes(spark, [(1, 5), (batch + 10, 1)], 100 - batch), 3)
        spans.append([r.batches for r in runs.runs()])
    assert spans == [[1], [2], [2, 1], [4], [4, 1]]
    merged = {r.lb_key[0]: (r.lb_docs, r.lb_last) for r in runs.merged().collect()}
    assert merged[1] == (5, 100) and merged[12] == (1, 98)  # hash 1 was settled by the first batch
    newest = runs._table(runs.runs()[-1])
    assert [r.lb_key[0] for r in newest.collect()] == [14]
    # A batch with a larger id is not left out, whatever is settled.
    runs.add(hashes(spark, [(1, 1)], 500), 3)
    assert {r.lb_key[0]: r.lb_last for r in runs.merged().collect()}[1] == 500


def test_runs_and_merges_that_broke_off_don_t_count(spark):
    path = new_folder(spark, "runs")
    runs = line_dedup.LineRuns(spark, path, buckets=2)
    parts = [line_dedup.Run(0, 0, 2), line_dedup.Run(1, 1, 2)]
    for part in parts:
        runs._write(hashes(spark, [(part.first, 1)], 1), part)
    assert runs.runs() == parts
    merged = line_dedup.Run(0, 1, 2)
    runs._write(runs._merge(parts), merged)  # as a merge whose inputs are still there
    assert runs.runs() == [merged]
    spark.range(1).write.parquet(f"{path}/run-000002-000002-in-2")
    from letterbox import storage

    storage.remove(spark, f"{path}/run-000002-000002-in-2/_SUCCESS")
    assert runs.runs() == [merged]
    runs.add(hashes(spark, [(7, 1)], 7), 3)
    assert [(r.first, r.last) for r in runs.runs()] == [(0, 1), (2, 2)]


def test_runs_merge_without_a_shuffle_and_no_python_runs(spark, documents):
    runs = line_dedup.LineRuns(spark, new_folder(spark, "runs"), buckets=4)
    for batch in range(3):
        runs.add(hashes(spark, [(k, 1) for k in range(batch, 60)], batch), 3)
    assert [r.batches for r in runs.runs()] == [2, 1]
    merged = runs.merged()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert sorted((r.lb_key[0], r.lb_docs) for r in merged.collect()) == [(k, min(k + 1, 3)) for k in range(60)]
    docs = documents([(1, "x" * 30), (2, "x" * 30), (3, "x" * 30)])
    frames = (
        line_dedup.drop_repeated_lines(docs),
        line_dedup.batch_hashes(docs.select(F.col("doc_id").alias(ID), F.col("text").alias(TEXT))),
    )
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
