"""Partitions replaced by a switch, versions read again, refreshes of what changed."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from letterbox import storage
from letterbox.model import LoadOptions
from letterbox.plans import load
from letterbox.plans.merge import upsert
from letterbox.plans.refresh import Target, refresh_changed
from letterbox.sinks import tables, versions

from .conftest import FIELDS, envelope

ODD = "a b%/1"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, p string")


@pytest.fixture
def target(spark, tmp_path):
    """A table of three partitions, one of them NULL, whose versions are kept."""
    name = f"v{uuid.uuid4().hex}.t"
    first = rows_of(spark, (1, "x"), (2, None), (3, ODD), (4, ODD))
    tables.create_table(spark, name, first.schema, str(tmp_path / "t"), ["p"], database_location=str(tmp_path / "db"))
    tables.save(first, name, "append")
    assert versions.enable(spark, name) == 1
    return name


def content(df):
    return sorted((r.id, r.p) for r in df.select("id", "p").collect())


def first_rows():
    return sorted([(1, "x"), (2, None), (3, ODD), (4, ODD)])


def files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_a_replacement_moves_no_file_and_the_old_version_stays(spark, target):
    before = files(spark, target)
    assert tables.save(rows_of(spark, (30, ODD), (5, "y")), target, "overwrite")["rows"] == 2
    assert content(spark.table(target)) == [(1, "x"), (2, None), (5, "y"), (30, ODD)]
    assert len(before & files(spark, target)) == 2
    assert content(versions.as_of(spark, target, 1)) == first_rows()
    assert content(versions.as_of(spark, target)) == content(spark.table(target))
    history = versions.version_history(spark, target).orderBy("version").collect()
    assert [(r.version, r.rows, r.partitions) for r in history] == [(1, None, 3), (2, 2, 4)]
    assert [versions.partition_values(p) for p in history[1].replaced] == [{"p": ODD}, {"p": "y"}]


def test_null_partitions_are_replaced_too(spark, target):
    versions.replace(rows_of(spark, (20, None)), target)
    assert content(spark.table(target).filter("p IS NULL")) == [(20, None)]
    assert content(versions.as_of(spark, target, 1).filter("p IS NULL")) == [(2, None)]


def test_lost_before_the_note_nothing_has_changed(spark, target, monkeypatch):
    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_write", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            versions.replace(rows_of(spark, (30, ODD)), target)
    assert content(spark.table(target)) == first_rows()
    assert versions.replace(rows_of(spark, (30, ODD)), target)["rows"] == 1
    root = tables._described(spark, target)["location"]
    assert len([n for n in storage.children(spark, f"{root}/_versions") if not n.endswith(".json")]) == 2
    assert versions.clean(spark, target, keep=2) == []
    assert len([n for n in storage.children(spark, f"{root}/_versions") if not n.endswith(".json")]) == 1
    assert content(spark.table(target)) == [(1, "x"), (2, None), (30, ODD)]


@pytest.mark.parametrize("calls", [0, 1, 2])
def test_lost_within_the_switch_it_is_finished_later(spark, target, monkeypatch, calls):
    whole = versions._switch

    def some(spark, table, root, before, places):
        changed = sorted(p for p in places if before.get(p) != places[p])[:calls]
        whole(spark, table, root, before, before | {p: places[p] for p in changed})
        raise RuntimeError("driver lost")

    wanted = [(30, ODD), (40, "y"), (20, None)]
    with monkeypatch.context() as broken:
        broken.setattr(versions, "_switch", some)
        with pytest.raises(RuntimeError, match="driver lost"):
            versions.replace(rows_of(spark, *wanted), target, whole=True)
    # Each partition is the old or the new one, never a mixture.
    seen = content(spark.table(target))
    assert set(seen) <= set(first_rows()) | set(wanted)
    assert not {(3, ODD), (30, ODD)} <= set(seen)
    assert versions.settle(spark, target).number == 2
    assert content(spark.table(target)) == sorted(wanted, key=lambda r: r[0])


def test_a_lost_catalog_entry_comes_back_from_the_newest_version(spark, target):
    versions.replace(rows_of(spark, (30, ODD)), target, emptied=["p=x"])
    root, schema = tables._described(spark, target)["location"], spark.table(target).schema
    tables.drop_table(spark, target)
    tables.create_table(spark, target, schema, root, ["p"])
    versions.recover(spark, target)
    assert content(spark.table(target)) == [(2, None), (30, ODD)]
    assert content(versions.as_of(spark, target, 1)) == first_rows()


def test_cleaning_keeps_what_is_in_use(spark, target):
    for i in (10, 11, 12):
        versions.replace(rows_of(spark, (i, ODD)), target)
    assert versions.clean(spark, target, keep=2) == [1, 2]
    assert content(spark.table(target)) == [(1, "x"), (2, None), (12, ODD)]
    assert content(versions.as_of(spark, target, 3)) == [(1, "x"), (2, None), (11, ODD)]
    with pytest.raises(LookupError, match="no version 1, only 3 to 4"):
        versions.as_of(spark, target, 1)
    assert len(files(spark, target)) == 3
    with pytest.raises(ValueError):
        versions.clean(spark, target, keep=0)


def test_other_writes_make_versions_or_refuse(spark, target):
    tables.clear_partition(spark, target, {"p": ODD})
    assert content(spark.table(target)) == [(1, "x"), (2, None)]
    upsert(spark, rows_of(spark, (1, "z"), (9, "x")), target, ["id"])
    assert content(spark.table(target)) == [(1, "z"), (2, None), (9, "x")]
    tables.rebuild(rows_of(spark, (7, "k")), target, "unused")
    assert content(spark.table(target)) == [(7, "k")]
    assert content(versions.as_of(spark, target, 1)) == first_rows()
    with pytest.raises(ValueError, match="keeps versions"):
        tables.save(rows_of(spark, (1, "x")), target, "append")
    with pytest.raises(ValueError, match="keeps versions"):
        tables.compact(spark, target)


def test_a_replacement_by_nothing_and_one_from_the_table_itself(spark, target):
    versions.replace(spark.table(target).withColumn("id", F.col("id") + 100), target)
    assert content(spark.table(target)) == [(i + 100, p) for i, p in first_rows()]
    versions.replace(rows_of(spark), target)
    assert content(spark.table(target)) == [(i + 100, p) for i, p in first_rows()]
    versions.replace(rows_of(spark), target, whole=True)
    assert content(spark.table(target)) == [] == content(versions.as_of(spark, target))


def test_a_table_without_partitions(spark, tmp_path):
    name, rows = f"v{uuid.uuid4().hex}.t", rows_of(spark, (1, "x"), (2, None))
    tables.create_table(spark, name, rows.schema, str(tmp_path / "t"), database_location=str(tmp_path / "db"))
    tables.save(rows, name, "append")
    versions.enable(spark, name)
    tables.save(rows_of(spark, (3, "y")), name, "overwrite")
    tables.save(rows_of(spark, (4, "y")), name, "overwrite")
    assert content(spark.table(name)) == [(4, "y")]
    assert [content(versions.as_of(spark, name, v)) for v in (1, 2, 3)] == [[(1, "x"), (2, None)], [(3, "y")], [(4, "y")]]
    versions.clean(spark, name, keep=1)
    assert content(spark.table(name)) == [(4, "y")] and versions.numbers(spark, str(tmp_path / "t")) == [3]


def test_loads_keep_versions_and_read_the_first_of_two_overwrites(spark, messages, tmp_path):
    options = LoadOptions(
        str(tmp_path / "raw"), database_prefix=f"r{uuid.uuid4().hex}_", mode_override="overwrite", versions=True, evolve=True
    )
    day = load.parse_day("2024-01-10")

    def run(step, fields, *payload):
        load.land(messages(envelope(payload=payload, fields=fields)), str(tmp_path / f"landing{step}"))
        load.raise_on_failure(load.load_landed(spark, str(tmp_path / f"landing{step}"), day, options))

    run(1, FIELDS, {"id": 1, "store": "a", "day": "2024-01-01"})
    wider = FIELDS + [{"name": "tax", "dataType": "double", "nullable": True, "metadata": {}}]
    run(2, wider, {"id": 2, "store": "b", "day": "2024-01-01", "tax": 1.5}, {"id": 3, "store": "b", "day": None})
    name = f"{options.database_prefix}app.sales"
    assert sorted(r.id for r in spark.table(name).collect()) == [2, 3]
    first = [v for v in versions.numbers(spark, f"{tmp_path}/raw/raw/app/sales")][1]
    old = versions.as_of(spark, name, first)
    assert [r.id for r in old.collect()] == [1] and "tax" not in old.columns
    assert "tax" in versions.as_of(spark, name).columns


def derived(spark, tmp_path, origins, build=None):
    made = Target(f"v{uuid.uuid4().hex}.made", str(tmp_path / "made"), partitions=("p",), database_location=str(tmp_path / "made.db"))
    asked = []

    def own(frames):
        asked.append({name: content(df) for name, df in frames.items()})
        return build(frames) if build else frames[origins].withColumn("id", F.col("id") * 2)

    return made, asked, lambda: refresh_changed(spark, own, made, origins)


def test_a_refresh_reads_and_writes_only_what_changed(spark, target, tmp_path):
    made, asked, run = derived(spark, tmp_path, target)
    assert (run().rows, run().status) == (4, "empty")
    before = files(spark, made.name)
    versions.replace(rows_of(spark, (30, ODD)), target, emptied=["p=x"])
    assert run().rows == 1
    assert asked[1:] == [{target: [(30, ODD)]}]
    assert content(spark.table(made.name)) == [(4, None), (60, ODD)]
    assert len(before & files(spark, made.name)) == 1
    assert run().status == "empty" and len(asked) == 2


def test_a_refresh_that_breaks_off_is_made_again(spark, target, tmp_path, monkeypatch):
    made, asked, run = derived(spark, tmp_path, target)
    run()
    versions.replace(rows_of(spark, (30, ODD)), target)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_write", lost)
        with pytest.raises(RuntimeError, match="driver lost"):
            run()
    assert run().rows == 1 and asked[1] == asked[2]
    assert content(spark.table(made.name)) == [(2, "x"), (4, None), (60, ODD)]


def test_versions_forgotten_since_or_another_origin_concern_all(spark, target, tmp_path):
    made, asked, run = derived(spark, tmp_path, target)
    run()
    versions.replace(rows_of(spark, (30, ODD)), target)
    versions.clean(spark, target, keep=1)
    assert run().rows == 3 and asked[1][target] == [(1, "x"), (2, None), (30, ODD)]

    lookup = f"v{uuid.uuid4().hex}.lookup"
    names = rows_of(spark, (1, "n"))
    tables.create_table(spark, lookup, names.schema, str(tmp_path / "l"), database_location=str(tmp_path / "l.db"))
    tables.save(names, lookup, "append")
    versions.enable(spark, lookup)
    both, asked, run = derived(spark, tmp_path / "both", f"{target}, {lookup}", lambda frames: frames[target])
    assert run().rows == 3
    versions.replace(rows_of(spark, (50, "x")), target)
    assert run().rows == 1 and asked[1][lookup] == [(1, "n")]
    versions.replace(rows_of(spark, (2, "n")), lookup)
    assert run().rows == 3


def test_rows_outside_the_partitions_concerned_fail_the_refresh(spark, target, tmp_path):
    made, _, run = derived(spark, tmp_path, target, lambda frames: frames[target].withColumn("p", F.lit("all")))
    run()
    versions.replace(rows_of(spark, (30, ODD)), target)
    with pytest.raises(ValueError, match="not to be replaced: p=all"):
        run()
    assert len(content(spark.table(made.name))) == 4
    with pytest.raises(LookupError, match="keeps no versions"):
        refresh_changed(spark, lambda f: f, made, _plain(spark, tmp_path))


def _plain(spark, tmp_path):
    name, rows = f"v{uuid.uuid4().hex}.plain", rows_of(spark, (1, "x"))
    tables.create_table(spark, name, rows.schema, str(tmp_path / "p"), ["p"], database_location=str(tmp_path / "p.db"))
    return name
