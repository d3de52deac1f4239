"""Plan shapes that matter at scale."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrameWriter, functions as F

from tests.conftest import envelope
from letterbox import storage
from letterbox.functions.dates import previous_day_window
from letterbox.functions.schemas import pick, payload_schema
from letterbox.operators import envelopes as env
from letterbox.operators.payload import typed_payload
from letterbox.model import LoadOptions
from letterbox.plans import load, merge
from letterbox.plans.merge import latest
from letterbox.sinks.tables import partition_id
from letterbox.sinks.landing import accepted, land, landing_rows, rejected
from letterbox.sinks import staged, tables, versions
from letterbox.sinks.tables import spread, with_constants
from letterbox.sources.files import read_landing
from letterbox.sources.hub import read_messages


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def hub_folder(messages, tmp_path):
    path = str(tmp_path / "hub")
    messages(envelope(payload=[{"id": 1}])).withColumn(
        "enqueuedTime", F.lit("2024-01-10 05:00:00").cast("timestamp")
    ).write.parquet(path)
    return path


def test_window_reaches_the_scan_and_each_body_is_parsed_once(spark, messages, tmp_path):
    window = previous_day_window("2024-01-11")
    read = read_messages(spark, "parquet", {}, window, path=hub_folder(messages, tmp_path))
    text = plan(landing_rows(read))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(enqueuedTime,.*LessThan\(enqueuedTime,", text)
    assert len(re.findall(r"(?m)^(?:Arguments|Output|Condition).*from_json\(", text)) == 1
    assert text.count("Exchange") == 0


def test_landing_shuffles_once_and_may_split_a_hot_table(spark, messages):
    text = plan(spread(landing_rows(messages(envelope(payload=[{"id": 1}]))), ["header_destino_diretorio"]))
    assert "REBALANCE_PARTITIONS_BY_COL" in text


def test_specs_read_headers_only_and_collapse_before_the_shuffle(spark, messages, tmp_path):
    land(messages(envelope(payload=[{"id": 1}])), str(tmp_path / "l"), "parquet")
    text = plan(env.resolve_specs(accepted(read_landing(spark, str(tmp_path / "l"), fmt="parquet"))))
    schema = re.search(r"ReadSchema: (.*)", text).group(1)
    assert "conteudo" not in schema and "structType" in schema
    assert "PartitionFilters: [isnotnull(header_destino_diretorio" in text
    first_shuffle = text.index("hashpartitioning(tabela")
    assert text.index("partial_max(sent_at") < first_shuffle
    assert re.search(r"HashAggregate \(\d+\)\n +\+- Project", text)


def test_one_table_prunes_directories_and_keys_parse_key_fields_only(spark, messages, tmp_path):
    land(messages(envelope(payload=[{"id": 1}])), str(tmp_path / "l"), "parquet")
    one = read_landing(spark, str(tmp_path / "l"), "sales", "parquet")
    schema = payload_schema({"fields": envelope()["destino"]["structType"]["fields"]})
    text = plan(typed_payload(one, pick(schema, ["ID"])))
    assert "(header_destino_diretorio" in re.search(r"PartitionFilters: (.*)", text).group(1)
    assert re.search(r"ReadSchema: struct<conteudo:string>", text)
    assert "StructField(store" not in text


def test_latest_reduces_before_the_shuffle(spark):
    rows = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(latest(rows, ["k"]))
    assert text.index("partial_max(struct(") < text.index("hashpartitioning(k") and "Window" not in text


def test_a_hot_table_lands_in_several_files(spark, tmp_path):
    """Most messages go to one table; no single task may write them all."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    text = json.dumps(envelope("TABLE", payload=[{"id": 1, "store": "a"}]))
    hot = F.when(F.col("id") % 10 < 9, "hot").otherwise("cold")
    noise = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
    body = F.replace(F.replace(F.lit(text), F.lit("TABLE"), hot), F.lit('"l1"'), F.concat(F.lit('"'), noise, F.lit('"')))
    messages = spark.range(0, 20000, numPartitions=8).select(body.cast("binary").alias("body"))
    spark.conf.set(setting, "256k")
    try:
        land(messages, str(tmp_path / "landing"), "parquet")
    finally:
        spark.conf.unset(setting)
    files = {p.parent.name: 0 for p in (tmp_path / "landing").rglob("*.parquet")}
    for p in (tmp_path / "landing").rglob("*.parquet"):
        files[p.parent.name] += 1
    assert files["header_destino_diretorio=hot"] >= 4
    assert files["header_destino_diretorio=cold"] <= files["header_destino_diretorio=hot"]
    assert read_landing(spark, str(tmp_path / "landing"), "hot", "parquet").count() == 18000


def test_landing_tasks_are_sized_by_what_they_hold_not_by_compressed_bytes(spark, tmp_path):
    """Alike messages shuffle to next to nothing, but are sorted as whole rows."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    texts = [json.dumps(envelope(table, payload=[{"id": 1, "store": "a"}])) for table in ("hot", "cold", "cool")]
    body = F.when(F.col("id") % 1000 == 0, texts[1]).when(F.col("id") % 1000 == 1, texts[2]).otherwise(texts[0])
    messages = spark.range(0, 20000, numPartitions=4).select(body.cast("binary").alias("body"))
    path = tmp_path / "landing"
    spark.conf.set(setting, "1m")
    try:
        land(messages, str(path), "parquet")
    finally:
        spark.conf.unset(setting)
    files = {table: len(list((path / f"header_destino_diretorio={table}").glob("*.parquet"))) for table in ("hot", "cold", "cool")}
    assert files["hot"] >= 10 and files["cold"] <= 2 and files["cool"] <= 2
    landed = read_landing(spark, str(path), fmt="parquet").groupBy("header_destino_diretorio").count().collect()
    assert {r[0]: r[1] for r in landed} == {"hot": 19960, "cold": 20, "cool": 20}
    assert [p.name for p in tmp_path.iterdir()] == ["landing"]


def dealt_files(spark, messages, path, fmt="parquet") -> dict[str, int]:
    """Files by destination of messages landed in tasks of 1 MB."""
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1m")
    try:
        land(messages, str(path), fmt)
    finally:
        spark.conf.unset(setting)
    return {p.name.partition("=")[2]: len(list(p.glob("part-*"))) for p in path.iterdir() if "=" in p.name}


def alike(spark, *texts, rows=16000):
    """Messages that take turns among a few texts."""
    body = F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % len(texts) + 1).cast("int"))
    return spark.range(0, rows, numPartitions=4).select(body.cast("binary").alias("body"))


def sent(table, payload=None):
    return json.dumps(envelope(table, payload=[{"id": 1, "store": "a"}] if payload is None else payload))


def test_json_lands_in_tasks_of_its_own_bytes(spark, tmp_path):
    """Stage one of two_stage_load."""
    files = dealt_files(spark, alike(spark, sent("hot"), sent("other")), tmp_path / "landing", "json")
    assert files["hot"] >= 4 and files["other"] >= 4
    landed = read_landing(spark, str(tmp_path / "landing")).groupBy("header_destino_diretorio").count().collect()
    assert {r[0]: r[1] for r in landed} == {"hot": 8000, "other": 8000}


def test_broken_bodies_are_dealt_like_others(spark, tmp_path):
    """The quarantine has no destination, yet no task holds it whole."""
    printed = "{'event': 1, 'ok': True, 'text': '" + "x" * 400 + "'}"
    files = dealt_files(spark, alike(spark, sent("good"), printed), tmp_path / "landing")
    assert files["__HIVE_DEFAULT_PARTITION__"] >= 4 and files["good"] >= 4
    assert rejected(read_landing(spark, str(tmp_path / "landing"), fmt="parquet")).count() == 8000


def test_destinations_that_differ_in_case_are_dealt_apart(spark, tmp_path):
    files = dealt_files(spark, alike(spark, sent("click"), sent("CLICK")), tmp_path / "landing")
    assert files["click"] >= 4 and files["CLICK"] >= 4
    landed = read_landing(spark, str(tmp_path / "landing"), fmt="parquet").groupBy("header_destino_diretorio").count().collect()
    assert {r[0]: r[1] for r in landed} == {"click": 8000, "CLICK": 8000}


def test_five_destinations_of_a_size_get_tasks_each(spark, tmp_path):
    """What show_tables lands: no task holds two of them whole."""
    names = ["click", "error", "purchase", "signup", "view"]
    files = dealt_files(spark, alike(spark, *map(sent, names), rows=30000), tmp_path / "landing")
    assert sorted(files) == names and min(files.values()) >= 4
    assert read_landing(spark, str(tmp_path / "landing"), fmt="parquet").count() == 30000


def test_damaged_payloads_are_dealt_by_their_length(spark, tmp_path):
    """Payloads that are no JSON weigh what their text does."""
    damaged = [sent("hot", "not json " + "x" * 2000), sent("small", "null")]
    files = dealt_files(spark, alike(spark, *damaged, rows=4000), tmp_path / "landing")
    assert files["hot"] >= 4 > files["small"]
    landed = read_landing(spark, str(tmp_path / "landing"), fmt="parquet")
    assert landed.filter(F.length("conteudo") > 2000).count() == 2000


def test_a_constant_day_is_written_without_a_sort(spark, messages, tmp_path, monkeypatch):
    """Tasks of a landed day hold one row at a time, however many they read."""
    plans, whole = [], DataFrameWriter.insertInto

    def spy(self, table, overwrite=None):
        view = f"v_{uuid.uuid4().hex}"
        self._df.createOrReplaceTempView(view)
        plans.append(spark.sql(f"EXPLAIN INSERT INTO {table} SELECT * FROM {view}").first()[0])
        return whole(self, table, overwrite)

    monkeypatch.setattr(DataFrameWriter, "insertInto", spy)
    window, prefix = previous_day_window("2024-01-11"), f"p_{uuid.uuid4().hex}_"
    options = LoadOptions(base_path=str(tmp_path / "raw"), database_prefix=prefix)
    for number, mode in enumerate(("append", "overwrite", "append")):
        body = messages(envelope("sales", [{"id": number, "store": "a"}], modo_gravacao=mode))
        load.raise_on_failure(load.load_messages(spark, body, window, str(tmp_path / f"landing-{number}"), options))
    assert len(plans) == 3 and all("WriteFiles" in text and "Sort" not in text for text in plans), plans
    rows = spark.table(f"{prefix}app.sales").select("id", "year_partition", "month_partition", "day_partition").collect()
    assert sorted(map(tuple, rows)) == [(1, 2024, 1, 10), (2, 2024, 1, 10)]


def test_constants_reach_staged_and_versioned_writes(spark, tmp_path):
    rows, day = spark.range(3), {"day": 7}
    for kind in ("plain", "staged", "versioned"):
        name = f"p_{uuid.uuid4().hex}.target"
        schema = with_constants(rows, day).schema
        tables.create_table(spark, name, schema, str(tmp_path / kind), ["day"], database_location=str(tmp_path / f"{kind}.db"))
        if kind == "staged":
            staged.publish(spark, name, staged.stage(rows, name, "one", ["1"], constants=day))
        else:
            if kind == "versioned":
                versions.enable(spark, name)
            assert tables.save_day(rows, name, day, "overwrite", shuffle=True) == 3
        assert sorted(map(tuple, spark.table(name).collect())) == [(0, 7), (1, 7), (2, 7)]


def test_rows_aside_lie_in_files_of_few_rows(spark, tmp_path, monkeypatch):
    """Tasks that deal rows out hold what they read; alike rows take next to nothing in a file."""
    seen, whole = [], storage.remove

    def spy(session, path):
        seen.append(len(list((tmp_path / path.rpartition("/")[2]).glob("part-*"))))
        whole(session, path)

    monkeypatch.setattr(storage, "remove", spy)
    land(alike(spark, sent("hot"), rows=40000).coalesce(1), str(tmp_path / "landing"), "parquet")
    assert seen == [3]
    assert read_landing(spark, str(tmp_path / "landing"), fmt="parquet").count() == 40000


def test_a_hot_partition_is_split_on_insert(spark, tmp_path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    name = f"p_{uuid.uuid4().hex}.target"
    df = spark.range(0, 40000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("text"), F.when(F.col("id") % 10 < 9, 1).otherwise(2).alias("day")
    )
    tables.create_table(spark, name, df.schema, str(tmp_path / "data"), ["day"], database_location=str(tmp_path / "db"))
    spark.conf.set(setting, "256k")
    try:
        assert tables.save(df, name, "append")["rows"] == 40000
    finally:
        spark.conf.unset(setting)
    assert len(list((tmp_path / "data" / "day=1").glob("*.parquet"))) >= 4


def test_an_upsert_reads_keys_first_and_then_only_touched_partitions(spark, tmp_path):
    name = f"p_{uuid.uuid4().hex}.target"
    df = spark.range(20).select("id", F.col("id").alias("v"), (F.col("id") % 4).cast("int").alias("day"))
    tables.create_table(spark, name, df.schema, str(tmp_path / "data"), ["day"], database_location=str(tmp_path / "db"))
    tables.save(df, name, "append")
    chosen = spark.table(name).filter(partition_id(["day"]).isin(["=1", "=3"]))
    text = plan(chosen)
    assert "PartitionFilters: [" in text and "1 entries" in text
    assert chosen.count() == 10
    assert "ReadSchema: struct<id:bigint>" in plan(spark.table(name).select("id", "day"))
    assert "ReadSchema: struct<>" in plan(spark.table(name).groupBy("day").count())


def test_an_upsert_rewrites_touched_partitions_only(spark, tmp_path, monkeypatch):
    name = f"p_{uuid.uuid4().hex}.target"
    df = spark.range(40).select("id", F.col("id").alias("v"), (F.col("id") % 8).cast("int").alias("day"))
    tables.create_table(spark, name, df.schema, str(tmp_path / "data"), ["day"], database_location=str(tmp_path / "db"))
    tables.save(df, name, "append")
    plans = []

    def spy(df, *args, **kwargs):
        plans.append(plan(df))
        return tables.save(df, *args, **kwargs)

    monkeypatch.setattr(merge, "save", spy)
    merge.upsert(spark, df.filter("id IN (3, 11)").withColumn("v", F.lit(0)), name, ["id"])
    scan = re.search(r"Location: InMemoryFileIndex \[.*day=(\d)\]", plans[0])
    assert scan and scan.group(1) == "3", plans[0]
    assert "Exchange hashpartitioning" not in plans[0]
    assert spark.table(name).filter("v = 0").count() == 3 and spark.table(name).count() == 40
