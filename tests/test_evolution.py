"""Tables that grow from load to load."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F, types as T

from letterbox import storage
from letterbox.functions.dates import previous_day_window
from letterbox.model import LoadOptions
from letterbox.operators.evolution import SchemaConflict, evolved, fitted, widens
from letterbox.plans import load
from letterbox.sinks import schemas, tables
from letterbox.sinks.staged import finish, left_behind, publish, stage

from .conftest import envelope

DAYS = [previous_day_window(f"2024-01-{d}") for d in (10, 11, 12)]


def ddl(text):
    return T.StructType.fromDDL(text)


TYPES = "tinyint smallint int bigint float double decimal(5,2) decimal(12,2) decimal(14,4) decimal(20,0) decimal(24,2) date timestamp_ntz string boolean".split()
#: The largest value of each type, as text that casts to it.
MOST = {
    "tinyint": "127", "smallint": "32767", "int": "2147483647", "bigint": "9223372036854775807", "float": "1.5",
    "double": "1e300", "decimal(5,2)": "999.99", "decimal(12,2)": "9999999999.99", "decimal(14,4)": "9999999999.9999",
    "decimal(20,0)": "99999999999999999999", "decimal(24,2)": "9999999999999999999999.99", "date": "2024-02-29",
    "timestamp_ntz": "2024-02-29 12:00:00", "string": "x", "boolean": "true",
}


def test_files_of_every_type_that_widens_read_back_without_loss(spark, tmp_path):
    pairs = [(a, b) for a in TYPES for b in TYPES if a != b and widens(ddl(f"x {a}")["x"].dataType, ddl(f"x {b}")["x"].dataType)]
    assert {("int", "bigint"), ("int", "double"), ("bigint", "decimal(20,0)"), ("float", "double"), ("date", "timestamp_ntz"), ("decimal(12,2)", "decimal(14,4)")} <= set(pairs)
    assert not {("bigint", "int"), ("bigint", "double"), ("double", "float"), ("decimal(14,4)", "decimal(12,2)"), ("int", "string"), ("bigint", "decimal(14,4)"), ("int", "decimal(5,2)")} & set(pairs)
    for a in {a for a, _ in pairs}:
        row = spark.sql(f"SELECT CAST('{MOST[a]}' AS {a}) AS x UNION ALL SELECT NULL")
        row.write.parquet(f"{tmp_path}/{a}")
        for b in [b for first, b in pairs if first == a]:
            read = spark.read.schema(f"x {b}").parquet(f"{tmp_path}/{a}").filter("x IS NOT NULL").first().x
            assert read == row.filter("x IS NOT NULL").selectExpr(f"CAST(x AS {b}) AS x").first().x, (a, b)


def test_schemas_grow_in_their_order_and_within_their_fields():
    old = ddl("id INT, deep STRUCT<a: INT, b: STRING>, many ARRAY<STRUCT<x: DATE>>, by MAP<STRING, INT>")
    new = ddl("NEW STRING, ID BIGINT, deep STRUCT<c: STRING, a: BIGINT>, many ARRAY<STRUCT<x: DATE, y: INT>>")
    grown = evolved(old, new)
    assert grown.simpleString() == ddl(
        "id BIGINT, deep STRUCT<a: BIGINT, b: STRING, c: STRING>, many ARRAY<STRUCT<x: DATE, y: INT>>, by MAP<STRING, INT>, NEW STRING"
    ).simpleString()
    assert evolved(grown, new).simpleString() == grown.simpleString()
    for bad, name in (("id STRING", "id"), ("deep STRUCT<b: INT>", "deep.b"), ("many ARRAY<INT>", "many.element"), ("deep INT", "deep")):
        with pytest.raises(SchemaConflict, match=f"field {name} is"):
            evolved(old, ddl(bad))


def test_rows_are_fitted_to_grown_columns(spark):
    rows = spark.sql("SELECT 1 AS id, named_struct('a', 2) AS deep, array(named_struct('x', 1)) AS many, map('k', 3) AS by UNION ALL SELECT 2, NULL, NULL, NULL")
    want = ddl("id BIGINT, deep STRUCT<b: STRING, a: BIGINT>, many ARRAY<STRUCT<x: BIGINT, y: STRING>>, by MAP<STRING, BIGINT>, more DATE")
    found = fitted(rows, want)
    assert found.schema.simpleString() == want.simpleString()
    first, second = found.orderBy("id").collect()
    assert (first.deep.a, first.deep.b, first.many[0].x, first.many[0].y, first.by, first.more) == (2, None, 1, None, {"k": 3}, None)
    assert tuple(second) == (2, None, None, None, None)


@pytest.fixture
def run(spark, messages, tmp_path):
    """Loads the payloads of one table and day, with the fields given as DDL."""
    options = LoadOptions(base_path=str(tmp_path / "raw"), database_prefix=f"e{uuid.uuid4().hex}_", evolve=True)

    def go(day, fields, *payload, **changes):
        declared = [{"name": f.name, "dataType": f.dataType.simpleString()} for f in ddl(fields).fields]
        sent = messages(envelope("sales", payload, fields=declared, chave_tabela="id"))
        landing = str(tmp_path / uuid.uuid4().hex)
        return load.load_messages(spark, sent, DAYS[day], landing, LoadOptions(**{**options.__dict__, **changes}))[0]

    go.name = f"{options.database_prefix}app.sales"
    go.options = options
    return go


def rows(spark, name, *columns):
    return sorted((tuple(r) for r in spark.table(name).select(*columns).collect()), key=repr)


def test_a_day_adds_and_widens_and_later_days_may_lack_fields(spark, run):
    assert run(0, "id INT, store STRING", {"id": 1, "store": "a"}).status == "loaded"
    assert run(1, "id BIGINT, price DECIMAL(10,2)", {"id": 3_000_000_000, "price": 1.25}).rows == 1
    assert run(2, "store STRING, id BIGINT", {"id": 7, "store": "c"}).rows == 1
    found = rows(spark, run.name, "id", "store", F.col("price").cast("string"), "day_partition")
    assert found == [(1, "a", None, 9), (3_000_000_000, None, "1.25", 10), (7, "c", None, 11)]
    location = schemas.table_location(spark, run.name)
    history = schemas.schema_history(spark, location).orderBy("version").collect()
    assert [(r.version, r.added, r.widened) for r in history] == [(1, [], []), (2, ["price"], ["id"])]
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {run.name}").collect()}
    assert properties[schemas.VERSION] == "2"
    assert tables.partition_columns(spark, run.name) == ["year_partition", "month_partition", "day_partition"]


def test_a_narrower_field_fails_by_name_and_changes_nothing(spark, run):
    run(0, "id BIGINT, price DOUBLE", {"id": 1, "price": 2.5})
    result = run(1, "id INT, price DOUBLE, more STRING", {"id": 2, "price": 1.0, "more": "x"})
    assert result.status == "failed" and "field id is bigint in the table and int" in result.error
    assert rows(spark, run.name, "id", "price") == [(1, 2.5)] and "more" not in spark.table(run.name).columns
    assert schemas.schema_history(spark, schemas.table_location(spark, run.name)).count() == 0


def test_without_evolve_a_changed_schema_still_fails(run):
    run(0, "id INT", {"id": 1})
    assert run(1, "id INT, more STRING", {"id": 2, "more": "x"}, evolve=False).status == "failed"


def test_a_table_lost_in_the_midst_of_growing_comes_back_whole(spark, run, monkeypatch):
    run(0, "id INT, store STRING", {"id": 1, "store": "a"})

    def lost(*_):
        raise OSError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(schemas, "create_table", lost)
        assert run(1, "id BIGINT, more STRING", {"id": 2, "more": "x"}).status == "failed"
    assert not spark.catalog.tableExists(run.name)
    assert run(2, "id BIGINT", {"id": 5}).status == "loaded"  # fewer fields than the log knows
    assert rows(spark, run.name, "id", "store", "more") == [(1, "a", None), (5, None, None)]


def test_a_change_noted_but_not_made_is_made_by_the_next_load(spark, run, monkeypatch):
    run(0, "id INT", {"id": 1})
    with monkeypatch.context() as m:
        m.setattr(schemas, "changes", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        assert run(1, "id INT, more STRING", {"id": 2, "more": "x"}).status == "failed"
    location = schemas.table_location(spark, run.name)
    parts = tables.partition_columns(spark, run.name)
    stored = T.StructType([f for f in spark.table(run.name).schema.fields if f.name not in parts])
    schemas._record(spark, location, None, stored)
    schemas._record(spark, location, stored, evolved(stored, ddl("more STRING")))
    assert run(2, "id INT", {"id": 3}).status == "loaded"
    assert rows(spark, run.name, "id", "more") == [(1, None), (3, None)]
    assert schemas.schema_history(spark, location).count() == 2


def test_files_that_can_t_be_read_wider_are_refused(spark, run):
    run(0, "id INT", {"id": 1}, fmt="orc")
    assert "orc files can't be read with wider types: id" in run(1, "id BIGINT", {"id": 2}, fmt="orc").error
    assert run(1, "id INT, more STRING", {"id": 2, "more": "x"}, fmt="orc").status == "loaded"
    assert rows(spark, run.name, "id", "more") == [(1, None), (2, "x")]


# Appends that can be run again ------------------------------------------------------------


@pytest.fixture
def target(spark, tmp_path):
    df = spark.range(200).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("a b/"), F.col("id") % 5)).alias("p"), F.col("id") % 3)
    df = df.toDF("id", "p", "q")
    name = f"s{uuid.uuid4().hex}.t"
    tables.create_table(spark, name, df.schema, str(tmp_path / "t"), ["p", "q"], database_location=str(tmp_path / "db"))
    return name, df, str(tmp_path / "t")


def test_an_append_that_breaks_at_any_file_is_run_again(spark, target, monkeypatch):
    name, df, location = target
    for attempt, after in enumerate((0, 1, 7)):
        staged = stage(df, name, f"load-{attempt}", [str(attempt)])
        assert staged.rows == 200
        moved, whole = [], storage.rename_into

        def breaking(session, path, to):
            if len(moved) >= after:
                raise OSError("the driver is lost")
            moved.append(to)
            whole(session, path, to)

        with monkeypatch.context() as m:
            m.setattr(storage, "rename_into", breaking)
            with pytest.raises(OSError):
                publish(spark, name, staged)
        (found,) = left_behind(spark, location)
        assert found == staged
        for _ in range(2):  # twice: a run may also break off before it is marked as done
            publish(spark, name, found)
        finish(spark, location, found)
        assert left_behind(spark, location) == []
        counts = spark.table(name).groupBy("id").count()
        assert counts.filter(F.col("count") != attempt + 1).isEmpty() and counts.count() == 200
    assert spark.table(name).filter("p IS NULL").count() == 3 * 40
    assert spark.table(name).filter("p = 'a b/1' AND q = 2").select("id").distinct().count() == df.filter("p = 'a b/1' AND q = 2").count()


def test_what_was_not_written_whole_is_thrown_away(spark, target):
    name, df, location = target
    df.write.partitionBy("p", "q").parquet(f"{location}/_staged/half/files")
    assert spark.table(name).count() == 0
    assert left_behind(spark, location) == [] and not storage.exists(spark, f"{location}/_staged/half")


def batch(spark, landing, number, messages, *documents):
    from letterbox.sinks.landing import landing_rows

    landing_rows(messages(*documents)).write.partitionBy("header_destino_diretorio").parquet(f"{landing}/batch={number}")


@pytest.mark.parametrize("point", ["stage", "publish", "_mark_done", "finish"])
@pytest.mark.parametrize("forgotten", [False, True])
def test_batches_come_once_wherever_a_run_breaks_off(spark, messages, tmp_path, monkeypatch, point, forgotten):
    landing = str(tmp_path / "landing")
    run = LoadOptions(base_path=str(tmp_path / "raw"), database_prefix=f"b{uuid.uuid4().hex}_")
    sent = envelope(payload=[{"id": 1, "store": "a", "day": "2024-01-09"}, 5])
    batch(spark, landing, 0, messages, sent)

    def lost(*_, **__):
        raise OSError("the driver is lost")

    with monkeypatch.context() as m:
        m.setattr(load, point, lost)
        (result,) = load.load_batches(spark, landing, DAYS[0], run)
        assert result.status == "failed"
    if forgotten:  # another session, whose catalog doesn't know the table
        tables.drop_table(spark, f"{run.database_prefix}app.sales")
    batch(spark, landing, 1, messages, envelope(payload=[{"id": 2, "store": "b", "day": "2024-01-09"}]))
    for expected in ("loaded", "empty"):
        (result,) = load.load_batches(spark, landing, DAYS[0], run)
        assert result.status == expected, result.error
    assert rows(spark, f"{run.database_prefix}app.sales", "id", "store") == [(1, "a"), (2, "b")]
    day = f"{run.base_path}/_quarantine/{run.database_prefix}app/sales/2024-01-09"
    assert [r.rejected_element for r in spark.read.parquet(day).collect()] == ["5"]
