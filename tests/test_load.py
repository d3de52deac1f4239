import uuid
from datetime import date

import pytest

from tests.conftest import FIELDS, envelope
from letterbox import catalog
from letterbox.functions.cdn import cdn_declared, labelled
from letterbox.functions.dates import previous_day_window
from letterbox.model import LoadOptions, PartitionRule
from letterbox.plans import load
from letterbox.sinks.landing import land

WINDOW = previous_day_window("2024-01-11")


@pytest.fixture
def options(tmp_path):
    def build(**changes):
        return LoadOptions(base_path=str(tmp_path / "raw"), database_prefix=f"l_{uuid.uuid4().hex}_", **changes)

    return build


def run(spark, messages, tmp_path, options, *documents, tables=None):
    landing = str(tmp_path / f"landing-{uuid.uuid4().hex}")
    return {r.table: r for r in load.load_messages(spark, messages(*documents), WINDOW, landing, options, tables)}


def table(spark, options, name):
    return spark.table(f"{options.database_prefix}app.{name}")


def test_tables_of_different_schemas_load_in_one_run(spark, messages, tmp_path, options):
    run_options = options(audit_table=f"a_{uuid.uuid4().hex}.loads")
    other = [{"name": "code", "dataType": "integer"}]
    results = run(
        spark, messages, tmp_path, run_options,
        envelope("sales", [{"id": 1, "store": "a"}, {"id": 2, "store": "b"}]),
        envelope("stock", [{"code": "5"}], fields=other, chave_tabela="code"),
        "broken",
    )
    assert not [r.error for r in results.values() if r.error]
    assert {(r.table, r.status, r.mode, r.rows) for r in results.values()} == {("sales", "loaded", "append", 2), ("stock", "loaded", "append", 1)}
    row = table(spark, run_options, "stock").first()
    assert (row.code, row.header_id, row.year_partition, row.month_partition, row.day_partition) == (5, "stock-app", 2024, 1, 10)
    audit = catalog.history(spark, run_options.audit_table)
    assert {(r.tabela, r.rows, r.day) for r in audit.collect()} == {("sales", 2, date(2024, 1, 10)), ("stock", 1, date(2024, 1, 10))}


def test_one_bad_table_does_not_stop_the_others(spark, messages, tmp_path, options):
    run_options = options()
    run(spark, messages, tmp_path, run_options, envelope("nullkey", [{"id": 1, "store": "a"}]))
    results = run(
        spark, messages, tmp_path, run_options,
        envelope("good", [{"id": 1, "store": "a"}]),
        envelope("nullkey", [{"id": i, "store": "a"} for i in range(5)]),
        envelope("nullkey", [{"id": 1}, {"id": 2}], modo_gravacao="overwrite"),
        envelope("newnull", [{"id": 1}]),
        envelope("nokey", [{"id": 1}], chave_tabela="missing"),
        envelope("badschema", [{"id": 1}], fields=[{"name": "id", "dataType": "no such type"}]),
        envelope("badmode", [{"id": 1, "store": "a"}], modo_gravacao="sometimes"),
        tables=["good", "nullkey", "newnull", "nokey", "badschema", "badmode", "absent"],
    )
    assert {name: r.status for name, r in results.items()} == {
        "good": "loaded", "nullkey": "failed", "newnull": "failed", "nokey": "failed", "badschema": "failed", "badmode": "failed", "absent": "empty",
    }
    assert "store (2)" in results["nullkey"].error
    assert table(spark, run_options, "nullkey").count() == 1
    assert not spark.catalog.tableExists(f"{run_options.database_prefix}app.newnull")
    with pytest.raises(load.LoadFailed, match="nullkey"):
        load.raise_on_failure(list(results.values()))
    report = {r.tabela: r.status for r in load.report(spark, list(results.values())).collect()}
    assert report["absent"] == "empty"


def test_keys_may_be_header_columns(spark, messages, tmp_path, options):
    results = run(spark, messages, tmp_path, options(), envelope("sales", [{"id": 1}], chave_tabela="header_id, id"))
    assert results["sales"].status == "loaded"


@pytest.mark.parametrize("override, mode, expected", [(None, "append", 2), ("append", "append", 2), ("overwrite", "append", 1), ("append", "overwrite", 1), ("OVERWRITE", "append", 1)])
def test_run_mode_wins_only_when_it_is_overwrite(spark, messages, tmp_path, options, override, mode, expected):
    run_options = options(mode_override=override)
    for _ in range(2):
        run(spark, messages, tmp_path, run_options, envelope("sales", [{"id": 1, "store": "a"}], modo_gravacao=mode))
    assert table(spark, run_options, "sales").count() == expected


def test_subset_is_comma_text_and_empty_text_means_all(spark, messages, tmp_path, options):
    documents = [envelope(name, [{"id": 1, "store": "a"}]) for name in ("a", "b", "c")]
    assert set(run(spark, messages, tmp_path, options(), *documents, tables="a, c,a")) == {"a", "c"}
    assert set(run(spark, messages, tmp_path, options(), *documents, tables="")) == {"a", "b", "c"}


def test_partitions_by_rule_and_first_only(spark, messages, tmp_path, options):
    rule = PartitionRule("conteudo.day", source_type="date")
    run_options = options(partition_rules={"sales": rule}, first_only=True)
    documents = [
        envelope("sales", [{"id": 1, "store": "a", "day": "2023-12-31"}, {"id": 2, "store": "b", "day": "2023-12-30"}]),
        envelope("stock", [{"id": 1, "store": "a", "day": "2023-12-31"}]),
    ]
    run(spark, messages, tmp_path, run_options, *documents)
    assert [tuple(r)[-3:] for r in table(spark, run_options, "sales").collect()] == [("2023", "12", "31")]
    assert [tuple(r)[-3:] for r in table(spark, run_options, "stock").collect()] == [(2024, 1, 10)]


def test_two_stages_through_json_files(spark, messages, tmp_path, options):
    run_options, path = options(), str(tmp_path / "2024-01-11")
    land(messages(envelope("sales", [{"id": 1, "store": "a"}]), envelope("stock", [{"id": 1, "store": "a"}])), path)
    results = load.load_landed(spark, path, WINDOW.day, run_options, ["stock"])
    assert [(r.table, r.status, r.rows) for r in results] == [("stock", "loaded", 1)]
    assert not spark.catalog.tableExists(f"{run_options.database_prefix}app.sales")


def test_no_messages_at_all(spark, messages, tmp_path, options):
    assert run(spark, messages, tmp_path, options(), envelope("sales", quantidade=0)) == {}


def test_changed_schema_fails_that_table(spark, messages, tmp_path, options):
    run_options = options()
    run(spark, messages, tmp_path, run_options, envelope("sales", [{"id": 1, "store": "a"}]))
    changed = FIELDS + [{"name": "more", "dataType": "string"}]
    results = run(spark, messages, tmp_path, run_options, envelope("sales", [{"id": 1, "store": "a"}], fields=changed))
    assert results["sales"].status == "failed" and "more" in results["sales"].error


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_other_file_formats(spark, messages, tmp_path, options, fmt):
    run_options = options(fmt=fmt, mode_override="overwrite")
    for _ in range(2):
        run(spark, messages, tmp_path, run_options, envelope("sales", [{"id": 1, "store": "a", "day": "2024-01-10"}]))
    assert [(r.id, r.store, r.day) for r in table(spark, run_options, "sales").collect()] == [(1, "a", date(2024, 1, 10))]


def test_a_new_catalog_finds_what_lies_at_the_location(spark, messages, tmp_path, options):
    first, second = options(), options()
    for run_options in (first, second):
        run(spark, messages, tmp_path, run_options, envelope("sales", [{"id": 1, "store": "a"}]))
    assert table(spark, second, "sales").count() == 2


def test_messages_cannot_choose_a_path_outside_the_base(spark, messages, tmp_path, options):
    results = run(spark, messages, tmp_path, options(), envelope("sales", [{"id": 1, "store": "a"}], caminho="/raw/../../etc"))
    assert results["sales"].status == "failed" and "unsafe" in results["sales"].error


def test_daily_job(spark, messages, tmp_path, options):
    hub, run_options = str(tmp_path / "hub"), options()
    times = ["2024-01-09 23:59:59", "2024-01-10 00:00:00", "2024-01-10 23:59:59", "2024-01-11 00:00:00"]
    for i, time in enumerate(times):
        messages(envelope("sales", [{"id": i, "store": "a"}])).selectExpr(
            "body", f"CAST('{time}Z' AS TIMESTAMP) AS enqueuedTime"
        ).write.mode("append").parquet(hub)
    landing = str(tmp_path / "landing")
    results = load.ingest_day(spark, "parquet", {}, "2024-01-11", landing, run_options, path=hub)
    assert [(r.table, r.rows) for r in results] == [("sales", 2)]
    assert (tmp_path / "landing" / "2024-01-11").is_dir()
    assert sorted(r.id for r in table(spark, run_options, "sales").collect()) == [1, 2]
    messages(envelope("stock", [{"id": None, "store": "a"}])).selectExpr(
        "body", f"CAST('{times[1]}Z' AS TIMESTAMP) AS enqueuedTime"
    ).write.mode("append").parquet(hub)
    with pytest.raises(load.LoadFailed, match="stock"):
        load.ingest_day(spark, "parquet", {}, "2024-01-11", landing, run_options, path=hub)
    assert table(spark, run_options, "sales").count() == 4


def test_one_table_without_a_landing_zone(spark, messages, options):
    sent = messages(
        envelope("sales", [{"id": 1, "store": "a"}]),
        envelope("sales", [{"id": 2, "store": "a"}], _id="sales-other"),
        envelope("stock", [{"id": 3, "store": "a"}]),
    )
    run_options = options(mode_override="overwrite")
    assert load.load_one(spark, sent, WINDOW, "sales", run_options).rows == 2
    assert load.load_one(spark, sent, WINDOW, "sales", run_options, "sales-other").rows == 1
    assert [r.id for r in table(spark, run_options, "sales").collect()] == [2]
    assert load.load_one(spark, sent, WINDOW, "none", run_options).status == "empty"


def test_device_record_with_dashed_names(spark, messages, tmp_path, options):
    names = ["apFloors-0", "apMac", "apTags-0", "apTags-1", "apTags-2", "clientMac", "ipv4", "lat", "seenEpoch"]
    fields = [{"name": n, "dataType": "string", "nullable": True, "metadata": {}} for n in names]
    fields.append({"name": "data", "dataType": "date", "nullable": True, "metadata": {}})
    run_options = options(partition_rules={"device": PartitionRule("conteudo.data", source_type="date")})
    payload = [{"apTags-0": "t", "seenEpoch": 1591221548, "data": "2020-06-03"}, {"apTags-1": "u", "data": None}]
    results = run(spark, messages, tmp_path, run_options, envelope("device", payload, fields=fields, chave_tabela=""))
    assert results["device"].rows == 2
    rows = table(spark, run_options, "device").select("apTags-0", "seenEpoch", "year_partition", "month_partition", "day_partition")
    assert sorted(map(tuple, rows.collect()), key=repr) == [("t", "1591221548", "2020", "06", "03"), (None, None, None, None, None)]


def test_nested_access_log_record(spark, messages, tmp_path, options):
    record = {
        "id": "r1", "cp": 5, "geo": {"city": "c", "country": "BR"}, "message": {"status": "200", "bytes": 17},
        "netPerf": {"clientRTT": "12", "midMileLatency": "x", "netOriginLatency": 3}, "waf": "broken",
    }
    run_options = options(count_lost_values=True)
    document = envelope("log", [record], fields=cdn_declared()["fields"], chave_tabela="id")
    document["id"] = document.pop("_id")
    results = run(spark, messages, tmp_path, run_options, document)
    assert (results["log"].status, results["log"].lost_values) == ("loaded", 0), results["log"]
    stored = table(spark, run_options, "log")
    assert len(stored.columns) == 9 + 15 + 3
    row = stored.select(*labelled(stored, ["country", "HTTP Status Code", "Bytes", "Client RTT", "Mid Mile Latency", "Net Origin Latency", "p rate"])).first()
    assert tuple(row) == ("BR", "200", "17", 12, None, 3, None)
