"""What must not get lost on the way: elements, digits, days, errors, tables, batches."""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from letterbox import storage
from letterbox.functions.columns import lenient_cast
from letterbox.functions.dates import lookback_window, parse_day, previous_day_window
from letterbox.model import LoadOptions, PartitionRule
from letterbox.operators import envelopes as env
from letterbox.operators.envelopes import united
from letterbox.operators.payload import payload_rejects, typed_payload, with_rule
from letterbox.plans import load, merge
from letterbox.plans.merge import upsert
from letterbox.sinks import tables
from letterbox.sources import jdbc
from letterbox.sources.registry import partition_rules, read_documents, table_registry
from letterbox.streaming import streams

from .conftest import envelope

WINDOW = previous_day_window("2024-01-11")


@pytest.fixture
def options(tmp_path):
    def build(**changes):
        return LoadOptions(base_path=str(tmp_path / "raw"), database_prefix=f"r{uuid.uuid4().hex}_", **changes)

    return build


@pytest.mark.parametrize(
    "text, day",
    [
        ("2024-01-11", date(2024, 1, 11)),
        ("2024-01-11 23:59:59", date(2024, 1, 11)),
        ("2024-01-11T22:00:00-03:00", date(2024, 1, 12)),
        ("2024-01-11T01:00:00.1234567+02:00", date(2024, 1, 10)),
        ("2024-01-11T00:00:00Z", date(2024, 1, 11)),
        (datetime(2024, 1, 11, 22, tzinfo=timezone(timedelta(hours=-3))), date(2024, 1, 12)),
    ],
)
def test_days_are_utc(text, day):
    assert parse_day(text) == day


@pytest.mark.parametrize("text", ["2024-01-11garbage", "2024-01-11 25:00:00", "", "11/01/2024"])
def test_malformed_days_raise(text):
    with pytest.raises(ValueError):
        parse_day(text)


def test_rejected_elements_keep_id_and_text(messages):
    sent = messages(
        envelope(payload=[{"id": 1}, 5, [{"id": 2}, "x"], None]),
        envelope(payload="not json", quantidade=1),
        envelope(payload="", quantidade=3),
    )
    schema = T.StructType.fromDDL("id BIGINT")
    found = env.envelopes(sent)
    assert sorted(r.id for r in typed_payload(found, schema).collect()) == [1, 2]
    rejects = payload_rejects(found, schema).collect()
    assert sorted(r.rejected_element for r in rejects) == ['"x"', "5", "no payload", "not json", "null"]
    assert {r.header_id for r in rejects} == {"sales-app"}


def test_a_load_counts_and_keeps_what_it_rejects(spark, messages, options, tmp_path):
    sent = messages(envelope(payload=[{"id": 1, "store": "a"}, 5]), envelope(payload=[{"id": 2, "store": "b"}]))
    for mode, kept in (("append", 1), ("append", 2), ("overwrite", 1)):
        run = options(mode_override=mode) if mode == "overwrite" else options()
        run = LoadOptions(base_path=run.base_path, database_prefix="same_", mode_override=run.mode_override)
        (result,) = load.load_messages(spark, sent, WINDOW, str(tmp_path / uuid.uuid4().hex), run)
        assert (result.status, result.rejected) == ("loaded", 1)
        aside = spark.read.parquet(f"{run.base_path}/_quarantine/same_app/sales/2024-01-10")
        assert [r.rejected_element for r in aside.collect()] == ["5"] * kept
    spark.sql("DROP DATABASE same_app CASCADE")


def test_both_loaders_reject_the_same_messages(spark, messages, options, tmp_path):
    broken = envelope(payload=[{"id": 1, "store": "a"}])
    broken["origem"] = "text"
    sent = messages(broken, envelope(payload=[{"id": 2, "store": "b"}]))
    many, one = options(), options()
    (first,) = load.load_messages(spark, sent, WINDOW, str(tmp_path / "landing"), many)
    second = load.load_one(spark, sent, WINDOW, "sales", one)
    assert (first.rows, second.rows, second.rejected_messages) == (1, 1, 1)


def test_error_texts_are_whole(spark, messages, options, tmp_path):
    fields = [{"name": "n" * 3000, "dataType": "no such type"}]
    (result,) = load.load_messages(
        spark, messages(envelope(payload=[{"id": 1}], fields=fields)), WINDOW, str(tmp_path / "landing"), options()
    )
    assert result.status == "failed" and len(result.error) > 20
    fields = [{"name": "f" * 3000, "dataType": "long"}, {"name": "f" * 3000, "dataType": "string"}]
    sent = messages(*[envelope(payload=[{"id": 1}], fields=[f]) for f in fields])
    (result,) = load.load_messages(spark, sent, WINDOW, str(tmp_path / "second"), options())
    assert result.status == "failed" and "f" * 3000 in result.error


def test_lost_counts_are_counted_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "counts_of", lambda counted: None)
    name, df = f"c_{uuid.uuid4().hex}.t", spark.range(7)
    tables.create_table(spark, name, df.schema, str(tmp_path / "t"), database_location=str(tmp_path / "db"))
    assert tables.save(df, name, "append")["rows"] == 7


def test_long_decimals_keep_their_digits(messages):
    fields = [
        {"name": "amount", "dataType": "decimal(24,4)"},
        {"name": "deep", "dataType": {"type": "struct", "fields": [{"name": "p", "dataType": "decimal(24,4)"}]}},
    ]
    text = json.dumps(envelope(payload=[{"amount": 0, "deep": {"p": 0}}, 7], fields=fields))
    text = text.replace('"amount": 0', '"amount": 12345678901234567.1234').replace('"p": 0', '"p": -98765432109876543.2101')
    schema = T.StructType.fromDDL("amount DECIMAL(24,4), deep STRUCT<p: DECIMAL(24,4)>")
    (row,) = typed_payload(env.envelopes(messages(text)), schema).collect()
    assert row.amount == Decimal("12345678901234567.1234") and row.deep.p == Decimal("-98765432109876543.2101")


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
def test_partition_days_do_not_depend_on_the_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["2024-01-10T01:00:00Z", "2024-01-10 23:30:00", "2024-01-10", "2024-01-10T22:00:00-03:00", "bad", None]
        df = spark.createDataFrame([(t,) for t in texts], "at string")
        rule = PartitionRule("at", {"day": "dd"})
        days = [r.day for r in with_rule(df, rule).collect()]
        assert days == ["10", "10", "10", "11", None, None]
        typed = df.select(lenient_cast(F.col("at"), T.TimestampType()).alias("at"))
        assert [r.day for r in with_rule(typed, rule).collect()] == days
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_specs_of_a_day_are_united(spark, messages, options, tmp_path):
    new = [{"name": "id", "dataType": "long"}, {"name": "b", "dataType": "string"}]
    sent = messages(
        envelope(payload=[{"id": 1, "a": "x"}], fields=[new[0], {"name": "a", "dataType": "string"}], chave_tabela="id"),
        envelope(payload=[{"id": 2, "b": "y"}], fields=new, chave_tabela="id", timestamp="2024-01-10T05:00:00"),
    )
    both, newest = options(), options(schemas="newest")
    for run, columns in ((both, {"id", "a", "b"}), (newest, {"id", "b"})):
        (result,) = load.load_messages(spark, sent, WINDOW, str(tmp_path / uuid.uuid4().hex), run)
        assert result.status == "loaded"
        found = spark.table(f"{run.database_prefix}app.sales")
        assert columns == set(found.columns) & {"id", "a", "b"}
    with pytest.raises(ValueError, match="declared bigint and string"):
        united(T.StructType.fromDDL("id BIGINT"), [T.StructType.fromDDL("ID STRING")])


def test_tables_that_differ_in_case_both_fail(spark, messages, options, tmp_path):
    sent = messages(*[envelope(name, [{"id": 1, "store": "a"}]) for name in ("Sales", "sales", "stock")])
    run = options(mode_override="overwrite")
    results = {r.table: r for r in load.load_messages(spark, sent, WINDOW, str(tmp_path / "landing"), run)}
    assert {n: r.status for n, r in results.items()} == {"Sales": "failed", "sales": "failed", "stock": "loaded"}
    assert "Sales, sales" in results["sales"].error
    assert not spark.catalog.tableExists(f"{run.database_prefix}app.sales")


def test_long_windows_need_a_rule_and_windows_are_applied(spark, options, tmp_path):
    bodies = [(json.dumps(envelope(payload=[{"id": i, "store": "a", "day": f"2024-01-{i:02}"}])), f"2024-01-{i:02} 12:00:00") for i in range(8, 13)]
    sent = spark.createDataFrame(bodies, "body string, at string").selectExpr(
        "CAST(body AS BINARY) AS body", "CAST(at AS TIMESTAMP_NTZ) AS enqueuedTime"
    )


    long = lookback_window("2024-01-11", 2)
    (result,) = load.load_messages(spark, sent, long, str(tmp_path / "a"), options())
    assert result.status == "failed" and "partition rule" in result.error
    ruled = options(default_rule=PartitionRule("day", source_type="date"))
    (result,) = load.load_messages(spark, sent, long, str(tmp_path / "b"), ruled)
    assert (result.status, result.rows) == ("loaded", 3)
    (result,) = load.load_messages(spark, sent, WINDOW, str(tmp_path / "c"), options())
    assert result.rows == 1


def test_batches_load_once_and_a_broken_append_is_named(spark, options, tmp_path):
    hub, landing, run = str(tmp_path / "hub"), str(tmp_path / "landing"), options()

    def drop(i):
        body = json.dumps(envelope(payload=[{"id": i, "store": "a"}]))
        df = spark.createDataFrame([(body,)], "body string").selectExpr("CAST(body AS BINARY) AS body")
        df.write.mode("append").parquet(hub)
        stream = spark.readStream.schema("body binary").parquet(hub)
        streams.finish(streams.land_stream(stream, landing, str(tmp_path / "checkpoint"), files_per_table=2), 60)

    def ids():
        return sorted(r.id for r in spark.table(f"{run.database_prefix}app.sales").collect())

    for i in (1, 2):
        drop(i)
        (result,) = load.load_batches(spark, landing, WINDOW, run)
        assert result.status == "loaded" and ids() == list(range(1, i + 1))
    (result,) = load.load_batches(spark, landing, WINDOW, run)
    assert result.status == "empty" and ids() == [1, 2]
    drop(3)
    batch = max(int(n.split("=")[1]) for n in storage.children(spark, landing) if n.startswith("batch="))
    storage.mark(spark, f"{landing}_loads/sales/{batch}.begun")
    (result,) = load.load_batches(spark, landing, WINDOW, run)
    assert result.status == "failed" and "broke off" in result.error and ids() == [1, 2]
    storage.remove(spark, f"{landing}_loads/sales/{batch}.begun")
    load.raise_on_failure(load.load_batches(spark, landing, WINDOW, run))
    assert ids() == [1, 2, 3]


def test_an_unfinished_batch_waits(spark, options, tmp_path):
    landing = str(tmp_path / "landing")
    storage.mark(spark, f"{landing}/batch=0/header_destino_diretorio=sales/part.parquet")
    assert load.load_batches(spark, landing, WINDOW, options()) == []


def test_a_failed_rebuild_keeps_the_table(spark, tmp_path):
    name, df = f"b_{uuid.uuid4().hex}.t", spark.range(3).withColumn("p", F.lit(1))
    tables.create_table(spark, name, df.schema, str(tmp_path / "t"), ["p"], database_location=str(tmp_path / "db"))
    tables.save(df, name, "append")
    failing = df.withColumn("id", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        tables.rebuild(failing, name, str(tmp_path / "t"), ["p"])
    assert spark.table(name).count() == 3
    tables.rebuild(spark.table(name).filter("id = 1"), name, str(tmp_path / "t"), ["p"])
    assert [r.id for r in spark.table(name).collect()] == [1]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["db", "t"]


@pytest.mark.parametrize("recency", [[], ["v"]])
def test_upserts_read_only_their_partitions_and_leave_no_stage(spark, tmp_path, recency, monkeypatch):
    df = spark.range(40).select("id", F.col("id").alias("v"), (F.col("id") % 4).alias("p"))
    name = f"u_{uuid.uuid4().hex}.t"
    tables.create_table(spark, name, df.schema, str(tmp_path / "t"), ["p"], database_location=str(tmp_path / "db"))
    tables.save(df, name, "append")
    stage, plans = str(tmp_path / "stage"), []
    monkeypatch.setattr("letterbox.plans.merge.new_folder", lambda spark, label: stage)


    staged = merge._staged
    monkeypatch.setattr(merge, "_staged", lambda d, path: plans.append(d._jdf.queryExecution().executedPlan().toString()) or staged(d, path))
    updates = spark.createDataFrame([(1, 100, 1)], "id BIGINT, v BIGINT, p BIGINT")
    upsert(spark, updates, name, ["id"], recency=recency, fixed_partition=True)
    assert spark.table(name).filter("id = 1").first().v == 100 and spark.table(name).count() == 40
    assert not storage.exists(spark, stage)
    scans = [line for plan in plans for line in plan.splitlines() if f"{name}[" in line or "u_" in line and "FileScan" in line]
    assert all("PartitionFilters: []" not in line for line in scans)
    assert bool(scans) == bool(recency)  # without recency nothing is searched
    with pytest.raises(ValueError, match="no keys"):
        upsert(spark, updates, name, [])


def test_percent_signs_in_a_pull(spark):
    text = jdbc.window_query("select * from t where n like 'A%' and d between '%s' and '%s'", "2024-01-01", "2024-01-02")
    assert text == "select * from t where n like 'A%' and d between '2024-01-01' and '2024-01-02'"
    with pytest.raises(ValueError):
        jdbc.window_query("%s", "2024-01-01", "2024-01-02")


def test_several_partition_rules_raise(spark, tmp_path):
    rule = {"de": {"nome_coluna": "conteudo.created", "tipo": "timestamp"}, "para": {"year_partition": "yyyy"}}
    other = {"de": {"nome_coluna": "conteudo.sent", "tipo": "timestamp"}, "para": {"month_partition": "MM"}}
    target = {"diretorio": "log", "configuracao_particao": [], "particao": [rule, other]}
    (tmp_path / "d.json").write_text(json.dumps({"id": "x", "destino": target}))
    registry = table_registry(read_documents(spark, str(tmp_path)))
    assert len(registry.first().particoes) == 2
    with pytest.raises(ValueError, match="2 partition rules"):
        partition_rules(registry, ["log"])


