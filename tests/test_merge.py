import random
import uuid

import pytest
from pyspark.sql import functions as F

from letterbox.operators.quality import NullKeyError
from letterbox.plans.merge import latest, merge_statement, upsert
from letterbox.plans.refresh import Target, refresh
from letterbox.sinks import tables

DDL = "k1 INT, k2 STRING, v INT, version INT, part STRING"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def make(spark, tmp_path, rows, partitions=("part",)):
    name = f"m_{uuid.uuid4().hex}.target"
    df = frame(spark, rows)
    tables.create_table(spark, name, df.schema, str(tmp_path / "data"), partitions, database_location=str(tmp_path / "db"))
    tables.save(df, name, "append")
    return name


def expected(stored, updates, recency):
    """Row by row, on the driver."""
    best = {}
    for row in updates:
        key = row[:2]
        order = ((row[3],) if recency else ()) + tuple(v for v in row[2:])
        if key not in best or order > best[key][0]:
            best[key] = (order, row)
    result = {row[:2]: row for row in stored}
    for key, (_, row) in best.items():
        if recency and key in result and result[key][3] > row[3]:
            continue
        result[key] = row
    return sorted(result.values())


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("recency", [False, True])
def test_against_brute_force(spark, tmp_path, seed, recency):
    rng = random.Random(seed)
    keys = [(i, s) for i in range(12) for s in "ab"]

    def rows(chosen):
        return [(*k, rng.randrange(100), rng.randrange(5), rng.choice("pqrs")) for k in chosen]

    stored = rows(rng.sample(keys, 15))
    updates = rows(rng.choices(keys, k=14))
    partitions = ("part",) if seed % 2 else ()
    name = make(spark, tmp_path, stored, partitions)
    upsert(spark, frame(spark, updates), name, ["k1", "k2"], recency=["version"] if recency else [])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == expected(stored, updates, recency)


@pytest.mark.parametrize("lost", [False, True])
def test_untouched_partitions_keep_their_files_and_emptied_ones_are_cleared(spark, tmp_path, monkeypatch, lost):
    name = make(spark, tmp_path, [(1, "a", 1, 0, "p"), (2, "a", 1, 0, "q"), (3, "a", 1, 0, "r")])
    files = lambda part: {r.f for r in spark.table(name).filter(F.col("part") == part).select(F.input_file_name().alias("f")).collect()}
    before = files("r")
    if lost:  # the event with the counts never arrives
        monkeypatch.setattr(tables, "counts_of", lambda counted: None)
    updates = frame(spark, [(1, "a", 9, 0, "q")])
    upsert(spark, updates, name, ["k1", "k2"])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "a", 9, 0, "q"), (2, "a", 1, 0, "q"), (3, "a", 1, 0, "r")]
    assert files("r") == before and files("p") == set()
    upsert(spark, updates, name, ["k1", "k2"])
    assert spark.table(name).count() == 3


def test_null_partition_and_fixed_partition(spark, tmp_path):
    name = make(spark, tmp_path, [(1, "a", 1, 0, None), (2, "a", 1, 0, "q")])
    upsert(spark, frame(spark, [(1, "a", 5, 0, None), (4, "a", 5, 0, "new")]), name, ["k1", "k2"], fixed_partition=True)
    assert sorted((r.k1, r.v, r.part) for r in spark.table(name).collect()) == [(1, 5, None), (2, 1, "q"), (4, 5, "new")]
    upsert(spark, frame(spark, [(1, "a", 6, 0, "q")]), name, ["k1", "k2"])
    assert sorted((r.k1, r.v, r.part) for r in spark.table(name).collect()) == [(1, 6, "q"), (2, 1, "q"), (4, 5, "new")]


def test_null_keys_are_refused(spark, tmp_path):
    name = make(spark, tmp_path, [(1, "a", 1, 0, "p")])
    with pytest.raises(NullKeyError):
        upsert(spark, frame(spark, [(None, "a", 1, 0, "p")]), name, ["k1", "k2"])
    assert upsert(spark, frame(spark, []), name, ["k1", "k2"]) == 0
    assert spark.table(name).count() == 1


def test_latest_takes_whole_rows(spark):
    df = frame(spark, [(1, "a", 5, 1, "x"), (1, "a", 3, 2, None), (1, "a", 4, 2, None)])
    assert [tuple(r) for r in latest(df, ["k1", "k2"], ["version"]).collect()] == [(1, "a", 4, 2, None)]
    assert latest(df.select("k1"), ["k1"]).count() == 1


def test_refresh_modes(spark, tmp_path):
    view = f"v_{uuid.uuid4().hex}"
    frame(spark, [(1, "a", 1, 0, "p"), (2, "a", 2, 0, "q")]).createOrReplaceTempView(view)
    database = f"r_{uuid.uuid4().hex}"

    def target(name, **changes):
        return Target(f"{database}.{name}", str(tmp_path / name), partitions=("part",), database_location=str(tmp_path / "db"), **changes)

    targets = {"keyed": target("keyed", keys=("k1", "k2")), "bare": target("bare")}

    def build(origins, window):
        assert window.day.isoformat() == "2024-01-01"
        return {name: origins[view] for name in targets}

    def run(mode, tables=""):
        results = refresh(spark, build, targets, data_proc="2024-01-31", data_proc_init=30, mode=mode, origins=view, tables=tables)
        return {r.table.split(".")[-1]: (r.status, r.rows) for r in results}

    assert run("merge") == {"keyed": ("loaded", 2), "bare": ("failed", 0)}
    assert run("merge", "keyed") == {"keyed": ("loaded", 2)}
    assert spark.table(f"{database}.keyed").count() == 2
    assert run("append", "bare") == run("append", "bare") == {"bare": ("loaded", 2)}
    assert spark.table(f"{database}.bare").count() == 4
    assert run("drop") == {"keyed": ("loaded", 2), "bare": ("loaded", 2)}
    assert run("sideways", "bare") == {"bare": ("failed", 0)}
    assert run("merge", "absent") == {"absent": ("failed", 0)}


def test_merge_statement_is_sound_sql(spark):
    for recency in ([], ["version", "odd-name"]):
        text = merge_statement("db.t", ["k1", "odd-key"], recency).replace("{updates}", "updates")
        spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        assert ("struct" in text) == bool(recency) and "t.`odd-key` = s.`odd-key`" in text
