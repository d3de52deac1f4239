"""Loads, table writes, merges and inspection.

Each query writes to a folder of its own and returns what it reads back.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import catalog, storage
from ..functions.dates import lookback_window, parse_day, previous_day_window, processing_text, within
from ..functions.schemas import REJECTED_BODY, TABLE_COLUMN
from ..model import DAY_PARTITIONS, LoadOptions, PartitionRule
from ..operators import envelopes as env
from ..operators.payload import typed_payload, with_day, with_rule
from ..operators.quality import key_null_report as key_report, partition_counts
from ..plans import key_index, load
from ..plans.merge import upsert
from ..plans.refresh import Target, refresh, refresh_changed
from ..session import new_folder
from ..sinks import publish, schemas, tables, versions
from ..sinks.landing import accepted, land, rejected
from ..sources.files import read_landing
from ..sources.hub import read_message_stream, select_window
from ..sources.origins import read_origins
from ..sources.registry import read_documents, registry_options, table_registry
from ..streaming import streams
from .producer import messages, row_messages
from .registry import query, read

MONTH = lookback_window("2024-01-31", 30)
DAY = previous_day_window("2024-01-11")
MONTH_RULE = PartitionRule(
    "o_orderdate", {"year_partition": "yyyy", "month_partition": "MM"}, as_type="int"
)
EVENT_RULE = PartitionRule("ts", as_type="int")


def options(spark: SparkSession, **changes) -> LoadOptions:
    """Options of one run with a folder and databases of its own."""
    return LoadOptions(
        base_path=new_folder(spark, "raw"), database_prefix=f"raw_{uuid.uuid4().hex}_", **changes
    )


def event_messages(spark: SparkSession, sf_dir: str, columns: list[str] | None = None, **kwargs) -> DataFrame:
    events = read(spark, sf_dir, "events")
    return row_messages(events, F.col("event_type"), columns, enqueued=F.col("ts"), **kwargs)


def all_rows(spark: SparkSession, names: list[str], run: LoadOptions, *columns) -> DataFrame:
    """The loaded tables one below the other, with their name."""
    frames = [
        spark.table(f"{run.database_prefix}app.{name}").select(F.lit(name).alias("tabela"), *columns)
        for name in names
    ]
    return reduce(DataFrame.unionByName, frames)


def loaded(results) -> list[str]:
    load.raise_on_failure(results)
    return [r.table for r in results if r.status == "loaded"]


def new_table(spark: SparkSession, df: DataFrame, partitions=()) -> str:
    """A catalog table filled with ``df``."""
    name = f"raw_{uuid.uuid4().hex}.target"
    location = new_folder(spark, "target")
    tables.create_table(
        spark, name, df.schema, f"{location}/data", partitions, database_location=f"{location}/db"
    )
    tables.save(df, name, "append")
    return name


@query("""
SELECT event_type AS tabela, CAST(year(ts) AS INT) AS year_partition, CAST(month(ts) AS INT) AS month_partition,
       CAST(day(ts) AS INT) AS day_partition, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-28' GROUP BY ALL
""")
def load_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages of a look-back to a table each, partitioned by a payload column."""
    run = options(spark, default_rule=EVENT_RULE)
    sent = event_messages(spark, sf_dir, keys="event_id")
    window = lookback_window("2024-01-27", 24)
    results = load.load_messages(spark, sent, window, new_folder(spark, "landing"), run)
    rows = all_rows(spark, loaded(results), run, *DAY_PARTITIONS, "value")
    return rows.groupBy("tabela", *DAY_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
    )


@query("""
SELECT event_type AS tabela, count(*) AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL
""")
def load_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = options(spark, default_rule=EVENT_RULE)
    results = load.load_messages(
        spark, event_messages(spark, sf_dir), MONTH, new_folder(spark, "landing"), run, "click,view"
    )
    return all_rows(spark, loaded(results), run).groupBy("tabela").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT event_type AS tabela, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'loaded' END AS status,
       CASE WHEN event_type = 'error' THEN 0 ELSE n END AS rows
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
UNION ALL SELECT 'nothing', 'empty', 0
""")
def key_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table has NULL keys, one has no messages; the others load."""
    events = read(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    sent = row_messages(events, F.col("event_type"), keys="event_id, user_id")
    landing = new_folder(spark, "landing")
    land(sent, landing, "parquet")
    found = [r.diretorio for r in env.tables(read_landing(spark, landing, fmt="parquet")).toLocalIterator()]
    results = load.load_landed(
        spark, landing, MONTH.day, options(spark), [*found, "nothing"], landing_fmt="parquet"
    )
    return load.report(spark, results).select("tabela", "status", "rows")


@query("""
SELECT 'events' AS tabela, 'loaded' AS status, count(*) AS rows, count(DISTINCT event_type) AS distinct_specs,
       count(*) FILTER (event_type = 'error') AS lost_values FROM events
""")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a load whose messages disagree on the mode and hold bad values."""
    events = read(spark, sf_dir, "events")
    value = F.when(F.col("event_type") == "error", "n/a").otherwise(F.col("value").cast("string"))
    sent = row_messages(
        events.withColumn("value", value),
        "events",
        ["event_id", "value"],
        declared={
            "fields": [
                {"name": "event_id", "dataType": "long", "nullable": True, "metadata": {}},
                {"name": "value", "dataType": "double", "nullable": True, "metadata": {}},
            ]
        },
        mode=F.when(F.col("event_type") == "view", "append").otherwise(F.col("event_type")),
        sent=F.when(F.col("event_type") == "view", "2024-01-10T09:00:00").otherwise("2024-01-10T08:00:00"),
        keys="event_id",
    )
    run = options(spark, count_lost_values=True)
    results = load.load_messages(spark, sent, DAY, new_folder(spark, "landing"), run)
    return load.report(spark, results).select("tabela", "status", "rows", "distinct_specs", "lost_values")


@query("""
SELECT 'event_id' AS key, 0::BIGINT AS null_count, 'OK' AS status
UNION ALL SELECT 'user_id', count(*) FILTER (user_id = 13),
                 CASE WHEN count(*) FILTER (user_id = 13) > 0 THEN 'ERRO' ELSE 'OK' END FROM events
""")
def key_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").withColumn(
        "user_id", F.when(F.col("user_id") != 13, F.col("user_id"))
    )
    schema = events.select("event_id", "user_id").schema
    rows = typed_payload(env.envelopes(row_messages(events, "events")), schema)
    return key_report(rows, ["event_id", "user_id"])


@query("SELECT event_type AS header_destino_diretorio, count(*) AS n FROM events GROUP BY ALL")
def landing_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "landing")
    land(event_messages(spark, sf_dir), path, "json")
    return partition_counts(accepted(read_landing(spark, path)), [TABLE_COLUMN])


@query("""
SELECT event_id, ts, user_id, event_type, value, props, 2024 AS year_partition, 1 AS month_partition,
       10 AS day_partition FROM events WHERE event_type = 'signup'
""")
def two_stage_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage one lands JSON by destination, stage two loads one of them."""
    path, run = new_folder(spark, "landing"), options(spark)
    land(event_messages(spark, sf_dir), path, "json")
    day = previous_day_window("2024-01-11").day
    results = load.load_landed(spark, path, day, run, "signup")
    columns = [*read(spark, sf_dir, "events").columns, *DAY_PARTITIONS]
    return all_rows(spark, loaded(results), run, *columns).drop("tabela")


@query("""
SELECT event_id, ts, user_id, event_type, value, props, 'purchase-app' AS header_id, 10 AS day_partition
FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
""")
def single_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One destination of one day, straight from the hub."""
    run, window = options(spark), previous_day_window("2024-01-11")
    hub = select_window(event_messages(spark, sf_dir, keys="event_id"), window)
    result = load.load_one(spark, hub, window, "purchase", run, "purchase-app")
    columns = [*read(spark, sf_dir, "events").columns, "header_id", "day_partition"]
    return all_rows(spark, loaded([result]), run, *columns).drop("tabela")


@query("""
SELECT event_type || CAST(event_id AS VARCHAR) AS rejected_body FROM events WHERE event_type = 'error'
UNION ALL SELECT '{''event'': ' || CAST(event_id AS VARCHAR) || ', ''ok'': True}' FROM events
WHERE event_type = 'view'
""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of message arrive broken: plain text, and a printed Python dict."""
    path = new_folder(spark, "landing")
    events = read(spark, sf_dir, "events")
    good = row_messages(events.filter(~F.col("event_type").isin("error", "view")), F.col("event_type"))
    broken = events.select(
        F.when(F.col("event_type") == "error", F.concat("event_type", F.col("event_id").cast("string")))
        .when(
            F.col("event_type") == "view",
            F.concat(F.lit("{'event': "), F.col("event_id").cast("string"), F.lit(", 'ok': True}")),
        )
        .alias("body")
    ).filter(F.col("body").isNotNull())
    land(good.select("body").union(broken.select(F.col("body").cast("binary"))), path, "parquet")
    return rejected(read_landing(spark, path, fmt="parquet")).select(REJECTED_BODY)


@query("SELECT event_type AS tabela, 0::BIGINT AS n FROM events GROUP BY ALL")
def create_empty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty table for every destination, from the specs in its messages."""
    run = options(spark)
    specs = env.resolve_specs(env.envelopes(event_messages(spark, sf_dir), payload=False))
    names = []
    for row in specs.toLocalIterator():
        spec = env.table_spec(row)
        schema = with_day(spark.createDataFrame([], spec.schema), MONTH.day).schema
        tables.create_table(
            spark,
            spec.full_name(run.database_prefix),
            schema,
            spec.location(run.base_path),
            DAY_PARTITIONS,
            database_location=f"{run.base_path}/db",
        )
        names.append(spec.table)
    counts = [
        spark.table(f"{run.database_prefix}app.{name}").agg(
            F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("n")
        )
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query("SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY ALL")
def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, landing = options(spark, default_rule=MONTH_RULE), new_folder(spark, "landing")
    land(row_messages(read(spark, sf_dir, "orders"), "orders"), landing, "parquet")
    for _ in range(2):
        results = load.load_landed(spark, landing, MONTH.day, run, landing_fmt="parquet")
    return all_rows(spark, loaded(results), run, "o_orderstatus").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("""
SELECT CAST(day(ts) AS INT) AS day_partition, count(*) AS n FROM events
WHERE CAST(ts AS DATE) <> DATE '2024-01-10' OR event_type = 'purchase' GROUP BY ALL
""")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every day, then load one of them again with fewer rows."""
    events = read(spark, sf_dir, "events")
    run = options(spark, default_rule=EVENT_RULE, mode_override="overwrite")
    day = previous_day_window("2024-01-11")
    again = events.filter(F.col("event_type") == "purchase")
    for df, window in ((events, MONTH), (again, day)):
        sent = row_messages(df, "events", enqueued=F.col("ts"))
        hub = select_window(sent, window)
        results = load.load_messages(spark, hub, window, new_folder(spark, "landing"), run)
    return partition_counts(
        all_rows(spark, loaded(results), run, "day_partition"), ["day_partition"]
    )


@query("""
SELECT 2024 AS year_partition, 1 AS month_partition, CAST(d AS INT) AS day_partition, count(*) AS n
FROM events, (VALUES (9), (10)) AS days(d)
WHERE d = 9 OR event_type = 'click' GROUP BY ALL
""")
def replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows on two constant days, one of them then replaced, one emptied."""
    events = read(spark, sf_dir, "events")
    days = [parse_day(f"2024-01-{d:02d}") for d in (8, 9, 10)]
    name = new_table(spark, with_day(events, days[0]), DAY_PARTITIONS)
    for day, rows in (
        (days[1], events),
        (days[2], events),
        (days[2], events.filter(F.col("event_type") == "click")),
        (days[0], events.filter(F.col("event_id").isNull())),
    ):
        values = {"year_partition": day.year, "month_partition": day.month, "day_partition": day.day}
        tables.save_day(with_day(rows, day), name, values, "overwrite")
    return partition_counts(spark.table(name), DAY_PARTITIONS)


def _order_table(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Orders as rows and as a table partitioned by month."""
    orders = read(spark, sf_dir, "orders")
    return orders, new_table(spark, with_rule(orders, MONTH_RULE), MONTH_RULE.names)


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       CAST(year(o_orderdate) AS INT) AS year_partition
FROM orders
""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urgent orders come again with another status, each of them twice."""
    orders, name = _order_table(spark, sf_dir)
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT").withColumn("o_orderstatus", F.lit("Z"))
    updates = with_rule(urgent.unionByName(urgent), MONTH_RULE)
    upsert(spark, updates, name, ["o_orderkey"])
    return spark.table(name).select("o_orderkey", "o_orderstatus", "year_partition")


@query("""
SELECT CAST(year(d) AS INT) AS year_partition, CAST(month(d) AS INT) AS month_partition, count(*) AS n,
       count(DISTINCT o_orderkey) AS orders
FROM (SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1995-03-01' OR o_orderstatus = 'P'
                              THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END AS d FROM orders)
GROUP BY ALL
""")
def merge_moved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates carry rows to other partitions and leave two partitions empty."""
    orders, name = _order_table(spark, sf_dir)
    early = F.col("o_orderdate") < F.lit("1995-03-01").cast("timestamp_ntz")
    moved = orders.filter(early | (F.col("o_orderstatus") == "P")).withColumn(
        "o_orderdate", F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")
    )
    upsert(spark, with_rule(moved, MONTH_RULE), name, ["o_orderkey"])
    return spark.table(name).groupBy(*MONTH_RULE.names).agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderkey").alias("orders")
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'Z' END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 3 END AS version
FROM orders
""")
def merge_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order comes again in versions 2 and 3; finished ones are at 5 already."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    stored = orders.withColumn("version", F.when(F.col("o_orderstatus") == "F", 5).otherwise(1))
    name = new_table(spark, with_rule(stored, MONTH_RULE), MONTH_RULE.names)
    sent = [
        orders.withColumn("o_orderstatus", F.lit(status)).withColumn("version", F.lit(version))
        for status, version in (("Y", 2), ("Z", 3))
    ]
    updates = with_rule(sent[0].unionByName(sent[1]), MONTH_RULE)
    upsert(spark, updates, name, ["o_orderkey"], recency=["version"])
    return spark.table(name).select("o_orderkey", "o_orderstatus", "version")


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def drop_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that holds every row twice is dropped and written anew."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    name = new_table(spark, suppliers.unionByName(suppliers), ["s_nationkey"])
    tables.rebuild(suppliers, name, new_folder(spark, "rebuilt"), ["s_nationkey"])
    return spark.table(name).select(suppliers.columns)


def _refreshed(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """Orders of a look-back, refreshed on two days whose windows overlap."""
    view = f"orders_{uuid.uuid4().hex}"
    read(spark, sf_dir, "orders").createOrReplaceTempView(view)
    name = f"app_{uuid.uuid4().hex}.recent"
    folder = new_folder(spark, "app")
    target = Target(name, f"{folder}/recent", ("o_orderkey",), MONTH_RULE.names, database_location=f"{folder}/db")

    def build(origins, window):
        recent = origins[view].filter(within(origins[view], "o_orderdate", window))
        return {"recent": with_rule(recent, MONTH_RULE)}

    for day, init in (("1998-03-01 00:00:00", "1995-01-01"), ("1998-03-20 00:00:00", 700)):
        results = refresh(
            spark, build, {"recent": target}, data_proc=day, data_proc_init=init, mode=mode, origins=f"{view}, {view}"
        )
        load.raise_on_failure(results)
    return spark.table(name).select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("""
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1998-03-21'
""")
def refresh_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "merge")


@query("""
SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-03-20' - INTERVAL 700 DAY AND o_orderdate < TIMESTAMP '1998-03-21'
""")
def refresh_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir, "drop")


@query("""
SELECT o_orderstatus, strftime(o_orderdate, '%m') AS month_partition, count(*) AS n FROM orders GROUP BY ALL
""")
def register_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned files get a table; padded month numbers stay text."""
    orders = read(spark, sf_dir, "orders")
    path = new_folder(spark, "files")
    parts = ["o_orderstatus", "month_partition"]
    dated = orders.withColumn("month_partition", F.date_format("o_orderdate", "MM"))
    tables.spread(dated, parts).write.partitionBy(*parts).parquet(path)
    name = f"raw_{uuid.uuid4().hex}.orders"
    tables.register_partitioned(
        spark, name, path, dict.fromkeys(parts, "string"), database_location=new_folder(spark, "db")
    )
    return partition_counts(spark.table(name), parts)


@query("""
SELECT CAST(year(o_orderdate) AS INT) AS year_partition, CAST(month(o_orderdate) AS INT) AS month_partition,
       count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
       CASE WHEN count(*) FILTER (o_orderpriority = '1-URGENT') > 0
             AND count(*) FILTER (o_orderpriority <> '1-URGENT') > 0 THEN 2 ELSE 1 END AS files_before,
       CASE WHEN year(o_orderdate) >= 1998
             AND count(*) FILTER (o_orderpriority = '1-URGENT') > 0
             AND count(*) FILTER (o_orderpriority <> '1-URGENT') > 0 THEN 2 ELSE 1 END AS files_after
FROM orders GROUP BY year(o_orderdate), month(o_orderdate)
""")
def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends leave two files a partition; compaction makes them one, before 1998 only, and keeps the rows."""
    orders = with_rule(read(spark, sf_dir, "orders"), MONTH_RULE)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    name = new_table(spark, orders.filter(urgent), MONTH_RULE.names)
    tables.save(orders.filter(~urgent), name, "append")
    parts = list(MONTH_RULE.names)
    # Taken down before the files are replaced; one row per partition.
    before = spark.createDataFrame(
        [tuple(r) for r in tables.file_counts(spark, name).select("partition", "files").collect()],
        "partition string, files_before bigint",
    )
    tables.compact(spark, name, "year_partition < 1998")
    after = tables.file_counts(spark, name).select("partition", F.col("files").alias("files_after"))
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    rows = spark.table(name).groupBy(*parts).agg(F.count(F.lit(1)).alias("n"), cents)
    return (
        rows.withColumn("partition", tables.partition_id(parts))
        .join(before, "partition")
        .join(after, "partition")
        .drop("partition")
    )


@query("""
SELECT 'customer' AS origin, count(*) AS n FROM customer UNION ALL SELECT 'orders', count(*) FROM orders
""")
def origins_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    suffix = uuid.uuid4().hex
    for name in ("customer", "orders"):
        read(spark, sf_dir, name).createOrReplaceTempView(f"{name}_{suffix}")
    found = read_origins(spark, f"customer_{suffix}, orders_{suffix},customer_{suffix}")
    counts = [
        df.agg(F.lit(name.removesuffix(f"_{suffix}")).alias("origin"), F.count(F.lit(1)).alias("n"))
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query("SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    path = new_folder(spark, "topic")
    publish.publish(customers, "text", path=path)
    return spark.read.schema(customers.schema).json(path)


@query("""
SELECT * FROM (VALUES ('o_orderkey', 'bigint', false), ('o_orderstatus', 'string', false),
  ('o_orderdate', 'timestamp_ntz', false), ('header_id', 'string', false), ('header_versao', 'string', false),
  ('header_unidade_negocio', 'string', false), ('header_projeto', 'string', false),
  ('header_descricao', 'string', false), ('header_timestamp', 'string', false), ('header_lote', 'string', false),
  ('header_origem', 'struct<tipo:string,fonte:string,caminho:string,diretorio:string>', false),
  ('header_destino', 'struct<tipo:string,caminho:string,diretorio:string,chave_tabela:string,modo_gravacao:string,structType:string,quantidade:int>', false),
  ('year_partition', 'int', true), ('month_partition', 'int', true)) AS t(col_name, data_type, is_partition)
""")
def describe_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = options(spark, default_rule=MONTH_RULE)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    sent = row_messages(orders, "orders")
    results = load.load_messages(spark, sent, MONTH, new_folder(spark, "landing"), run)
    return catalog.describe(spark, f"{run.database_prefix}app.{loaded(results)[0]}")


@query('SELECT DISTINCT event_type AS "tableName", false AS "isTemporary" FROM events')
def show_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = options(spark, default_rule=EVENT_RULE)
    results = load.load_messages(
        spark, event_messages(spark, sf_dir), MONTH, new_folder(spark, "landing"), run
    )
    loaded(results)
    return catalog.show_tables(spark, f"{run.database_prefix}app").filter(
        ~F.col("isTemporary")
    ).select("tableName", "isTemporary")


@query("""
SELECT 'customer' AS tabela, 'append' AS mode, 'loaded' AS status, count(*) AS n FROM customer
UNION ALL SELECT 'customer', 'overwrite', 'loaded', count(*) FROM customer
""")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = f"audit_{uuid.uuid4().hex}.loads"
    run = options(spark, audit_table=audit)
    customers = read(spark, sf_dir, "customer")
    for mode in ("append", "overwrite"):
        sent = row_messages(customers, "customer", mode=mode, keys="c_custkey")
        loaded(load.load_messages(spark, sent, DAY, new_folder(spark, "landing"), run))
    return catalog.history(spark, audit, "customer").select(
        "tabela", "mode", "status", F.col("rows").alias("n")
    )


@query("""
SELECT lower(replace(s_name, '#', '_')) AS tabela,
       CASE WHEN s_acctbal < 0 THEN 'overwrite' ELSE 'append' END AS modo_gravacao,
       'north|south' AS chaves, 'updated_at' AS particao
FROM supplier
""")
def spec_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ingestion document per supplier, kept as JSON lines."""
    path = new_folder(spark, "documents")
    table = F.lower(F.translate("s_name", "#", "_"))
    rule = F.struct(
        F.struct(F.lit("conteudo.updated_at").alias("nome_coluna"), F.lit("timestamp").alias("tipo")).alias("de"),
        F.struct(
            F.lit("yyyy").alias("year_partition"),
            F.lit("MM").alias("month_partition"),
            F.lit("dd").alias("day_partition"),
        ).alias("para"),
    )
    documents = read(spark, sf_dir, "supplier").select(
        F.concat(table, F.lit("-shop")).alias("_id"),
        F.lit("shop").alias("fonte"),
        F.struct(table.alias("tabela"), F.lit("north, north, south").alias("chave_tabela")).alias("origem"),
        F.struct(
            F.array(rule).alias("configuracao_particao"),
            F.when(F.col("s_acctbal") < 0, "overwrite").otherwise("append").alias("modo_gravacao"),
        ).alias("destino"),
    )
    publish.publish(documents, "text", path=path)
    return table_registry(read_documents(spark, path, multi_line=False)).select(
        "tabela",
        "modo_gravacao",
        F.concat_ws("|", "chaves").alias("chaves"),
        F.regexp_replace(F.get("particoes", F.lit(0))["de"]["nome_coluna"], "^conteudo\\.", "").alias("particao"),
    )


@query("""
SELECT event_type AS tabela, 2024 AS year_partition, 1 AS month_partition, 10 AS day_partition,
       count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY event_type
""")
def daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scheduler calls once a day; the hub also holds all other days."""
    hub, run = new_folder(spark, "hub"), options(spark)
    event_messages(spark, sf_dir, keys="event_id").write.parquet(hub)
    results = load.ingest_day(spark, "parquet", {}, "2024-01-11", new_folder(spark, "landing"), run, path=hub)
    rows = all_rows(spark, loaded(results), run, *DAY_PARTITIONS, "event_id")
    return rows.groupBy("tabela", *DAY_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")
    )


@query("""
SELECT event_type AS tabela, event_id FROM events
WHERE ts >= TIMESTAMP '2024-01-16' AND ts < TIMESTAMP '2024-01-17'
""")
def trigger_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trigger of the 18th hands on the 17th as processing date, which loads the 16th."""
    handed_on = processing_text(datetime(2024, 1, 18, 3, 30))
    window, run = previous_day_window(handed_on), options(spark)
    sent = event_messages(spark, sf_dir)
    results = load.load_messages(spark, sent, window, new_folder(spark, "landing"), run)
    return all_rows(spark, loaded(results), run, "event_id")


def _damaged(spark: SparkSession, sf_dir: str, run: LoadOptions) -> list:
    """Messages whose payload is in part, or as a whole, no object, by the id of the event."""
    sent = event_messages(spark, sf_dir, columns=["event_id", "value", "ts"])
    body, number = F.col("body").cast("string"), F.get_json_object(F.col("body").cast("string"), "$.conteudo[0].event_id")
    payload = F.regexp_extract(body, '"conteudo":(.*),"lote"', 1)
    kind = number.cast("bigint") % 10
    other = (
        F.when(kind == 1, F.concat(F.lit("[5,"), F.substring(payload, F.lit(2), F.length(payload))))
        .when(kind == 2, F.lit('"not json"'))
        .when(kind == 3, F.lit("null"))
        .when(kind == 4, F.concat(F.lit("["), payload, F.lit(",null]")))
        .otherwise(payload)
    )
    damaged = F.concat(F.regexp_extract(body, '^(.*"conteudo":)', 1), other, F.lit(',"lote":"lot"}')).cast("binary")
    return load.load_messages(
        spark, sent.select(damaged.alias("body"), "enqueuedTime"), MONTH, new_folder(spark, "landing"), run
    )


@query("""
SELECT event_type AS tabela, count(*) FILTER (event_id % 10 NOT IN (2, 3)) AS rows,
       CAST(sum(CASE WHEN event_id % 10 IN (2, 3) THEN 0 ELSE event_id END) AS BIGINT) AS ids,
       count(*) FILTER (event_id % 10 IN (1, 2, 3, 4)) AS rejected,
       count(*) FILTER (event_id % 10 IN (1, 2, 3, 4)) AS kept_aside
FROM events GROUP BY event_type
""")
def payload_damage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good elements load; the others are counted and kept aside."""
    run = options(spark, default_rule=EVENT_RULE)
    results = _damaged(spark, sf_dir, run)
    rows = all_rows(spark, loaded(results), run, "event_id").groupBy("tabela").agg(F.sum("event_id").alias("ids"))
    aside = spark.read.parquet(
        *[f"{run.base_path}/_quarantine/{run.database_prefix}app/{r.table}/{MONTH.day}" for r in results if r.rejected]
    )
    table = F.regexp_replace("header_id", "-app$", "").alias("tabela")
    counted = load.report(spark, results).select("tabela", "rows", "rejected")
    kept = aside.groupBy(table).agg(F.count(F.lit(1)).alias("kept_aside"))
    return counted.join(rows, "tabela", "left").join(kept, "tabela", "left").fillna(0, ["ids", "kept_aside"])


@query("""
SELECT o_orderkey, o_custkey, 'first' AS part FROM orders
UNION ALL SELECT o_orderkey, o_custkey, 'second' FROM orders WHERE o_orderkey % 2 = 0
""")
def payload_nested_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists within the payload's list: all their elements count."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    element = lambda part: F.struct("o_orderkey", "o_custkey", F.lit(part).alias("part"))
    nested = F.array(F.array(element("first")), F.array(element("second")))
    payload = F.when(F.col("o_orderkey") % 2 == 0, nested).otherwise(F.array(F.array(element("first"))))
    schema = orders.schema.add("part", "string")
    return typed_payload(env.envelopes(messages(orders, F.lit("orders"), payload, schema)), schema)


@query("""
SELECT 'events' AS tabela, event_id, CASE WHEN event_id % 2 = 0 THEN user_id ELSE -1 END AS user_id, value FROM events
""")
def spec_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older messages declare a field that newer ones have dropped: the table has both."""
    events, run = read(spark, sf_dir, "events"), options(spark, default_rule=EVENT_RULE)
    old = row_messages(
        events.filter("event_id % 2 = 0"), "events", ["event_id", "user_id", "ts"], enqueued=F.col("ts"), sent="2024-01-10T01:00:00"
    )
    both = row_messages(
        events.filter("event_id % 2 = 0"), "events", ["event_id", "value", "ts"], enqueued=F.col("ts"), sent="2024-01-10T02:00:00"
    )
    new = row_messages(
        events.filter("event_id % 2 = 1"), "events", ["event_id", "value", "ts"], enqueued=F.col("ts"), sent="2024-01-10T02:00:00"
    )
    sent = old.unionByName(both).unionByName(new)
    results = load.load_messages(spark, sent, MONTH, new_folder(spark, "landing"), run)
    rows = all_rows(spark, loaded(results), run, "event_id", "user_id", "value")
    return rows.groupBy("tabela", "event_id").agg(
        F.coalesce(F.max("user_id"), F.lit(-1)).alias("user_id"), F.max("value").alias("value")
    )


@query("""
SELECT tabela, CASE WHEN lower(tabela) = 'click' THEN 'failed' ELSE 'loaded' END AS status,
       CASE WHEN lower(tabela) = 'click' THEN 0 ELSE n END AS rows
FROM (SELECT CASE WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'CLICK' ELSE event_type END AS tabela,
             count(*) AS n FROM events GROUP BY ALL)
""")
def same_name_other_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables that differ only in case would overwrite each other: both fail, the others load."""
    events = read(spark, sf_dir, "events")
    upper = (F.col("event_type") == "click") & (F.col("event_id") % 2 == 0)
    name = F.when(upper, F.upper("event_type")).otherwise(F.col("event_type"))
    sent = row_messages(events, name, enqueued=F.col("ts"), mode="overwrite")
    run = options(spark, default_rule=EVENT_RULE)
    results = load.load_messages(spark, sent, MONTH, new_folder(spark, "landing"), run)
    return load.report(spark, results).select("tabela", "status", "rows")


@query("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 END AS o_custkey FROM orders
""")
def register_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that only one partition's files have is part of the table."""
    orders, path = read(spark, sf_dir, "orders"), new_folder(spark, "files")
    finished = F.col("o_orderstatus") == "F"
    orders.filter(~finished).select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").parquet(path)
    late = orders.filter(finished).select("o_orderkey", "o_custkey", "o_orderstatus")
    late.write.mode("append").partitionBy("o_orderstatus").parquet(path)
    name = f"raw_{uuid.uuid4().hex}.orders"
    tables.register_partitioned(spark, name, path, {"o_orderstatus": "string"}, database_location=new_folder(spark, "db"))
    return spark.table(name).select("o_orderkey", "o_orderstatus", F.coalesce("o_custkey", F.lit(-1)).alias("o_custkey"))


@query("""
SELECT o_orderkey, CAST(123456789012345 AS BIGINT) * 10000 + o_orderkey % 10000 AS ten_thousandths FROM orders
""")
def decimal_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts with more digits than a double holds, sent as JSON numbers, flat and nested."""
    exact = (F.lit(123456789012345).cast("decimal(24,4)") + (F.col("o_orderkey") % 10000).cast("decimal(24,4)") / 10000)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", exact.cast("decimal(24,4)").alias("amount"))
    orders = orders.withColumn("deep", F.struct("amount"))
    run = options(spark)
    results = load.load_messages(
        spark, row_messages(orders, "orders"), DAY, new_folder(spark, "landing"), run
    )
    rows = all_rows(spark, loaded(results), run, "o_orderkey", "amount", "deep")
    same = F.when(F.col("amount") == F.col("deep.amount"), F.col("amount"))
    return rows.select("o_orderkey", (same * 10000).cast("bigint").alias("ten_thousandths"))


@query("""
SELECT lower(replace(s_name, '#', '_')) AS tabela, 'overwrite' AS mode, strftime(o_orderdate, '%Y') AS year_partition, count(*) AS n
FROM orders JOIN supplier ON s_suppkey = 1 + o_orderkey % 3 GROUP BY ALL
""")
def registry_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion documents give a load its partition rules, keys and write modes."""
    suppliers = read(spark, sf_dir, "supplier").withColumn("s_name", F.lower(F.translate("s_name", "#", "_")))
    documents, table = new_folder(spark, "documents"), F.col("s_name")
    rule = F.struct(
        F.struct(F.lit("conteudo.o_orderdate").alias("nome_coluna"), F.lit("timestamp").alias("tipo")).alias("de"),
        F.struct(F.lit("yyyy").alias("year_partition")).alias("para"),
    )
    target = F.struct(
        F.array(rule).alias("particao"),
        table.alias("diretorio"),
        F.lit("o_orderkey").alias("chave_tabela"),
        F.lit("OVERWRITE").alias("modo_gravacao"),
    )
    declared = suppliers.select(F.concat(table, F.lit("-app")).alias("_id"), target.alias("destino"))
    publish.publish(declared, "text", path=documents)
    registry = table_registry(read_documents(spark, documents, multi_line=False))

    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    supplier = F.col("s_suppkey") == 1 + F.col("o_orderkey") % 3
    sent = row_messages(orders.join(suppliers, supplier), table, ["o_orderkey", "o_orderdate"])
    names = [r.s_name for r in suppliers.filter("s_suppkey <= 3").select("s_name").collect()]
    run = registry_options(registry, names, options(spark))
    for _ in range(2):  # the messages say append, the documents overwrite
        results = load.load_messages(spark, sent, DAY, new_folder(spark, "landing"), run)
    counts = all_rows(spark, loaded(results), run, "year_partition").groupBy("tabela", "year_partition")
    modes = load.report(spark, results).select("tabela", "mode")
    return counts.agg(F.count(F.lit(1)).alias("n")).join(modes, "tabela")


@query("SELECT 'gone' AS state, count(*) AS files_rows FROM supplier")
def drop_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dropped table is gone from the catalog; its files stay."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    name = new_table(spark, suppliers)
    location = spark.table(name).select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "")).first()[0]
    tables.drop_table(spark, name)
    state = "present" if spark.catalog.tableExists(name) else "gone"
    return spark.read.parquet(location).agg(F.lit(state).alias("state"), F.count(F.lit(1)).alias("files_rows"))


@query("SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def show_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement shown for a table, run after dropping it, gives the table again."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    name = new_table(spark, suppliers, ["s_nationkey"])
    statement = catalog.show_create_table(spark, name)
    tables.drop_table(spark, name)
    spark.sql(statement)
    tables.recover_partitions(spark, name)
    return spark.table(name).select(suppliers.columns)


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE o_custkey + 3000000000 END AS customer,
       CAST(round(o_totalprice * 100) AS BIGINT) * 100 + CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE 7 END AS amount,
       CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE o_orderpriority END AS priority, o_orderstatus AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN '-' ELSE o_orderpriority END AS nested,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN 9 ELSE 10 END AS INT) AS day_partition,
       'bigint decimal(20,4)' AS types, 2::BIGINT AS versions, 'priority' AS added, 'customer,amount,deep' AS widened
FROM orders
""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second day's messages add a field, and one in a struct, and widen two: the first day's rows stay as they lie."""
    run, orders = options(spark, evolve=True), read(spark, sf_dir, "orders")
    cents, key = F.round(F.col("o_totalprice") * 100).cast("decimal(18,0)"), F.col("o_orderkey")
    first = orders.filter(key % 2 == 0).select(
        "o_orderkey",
        F.col("o_custkey").cast("int").alias("customer"),
        (cents / 100).cast("decimal(14,2)").alias("amount"),
        F.struct(F.col("o_orderstatus").alias("status")).alias("deep"),
    )
    second = orders.filter(key % 2 != 0).select(
        "o_orderkey",
        (F.col("o_custkey") + 3000000000).alias("customer"),
        (cents / 100 + F.lit(7).cast("decimal(18,0)") / 10000).cast("decimal(20,4)").alias("amount"),
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("deep"),
        F.col("o_orderpriority").alias("priority"),
    )
    for rows, processed in ((first, "2024-01-10"), (second, "2024-01-11")):
        window = previous_day_window(processed)
        sent = row_messages(rows, "orders", keys="o_orderkey", enqueued=F.lit(f"{window.day} 12:00:00").cast("timestamp_ntz"))
        load.raise_on_failure(load.load_messages(spark, sent, window, new_folder(spark, "landing"), run))
    name = f"{run.database_prefix}app.orders"
    types = {f.name: f.dataType.simpleString() for f in spark.table(name).schema.fields}
    past = schemas.schema_history(spark, schemas.table_location(spark, name)).agg(
        F.count(F.lit(1)).alias("versions"),
        F.max(F.array_join("added", ",")).alias("added"),
        F.max(F.array_join("widened", ",")).alias("widened"),
    )
    return spark.table(name).select(
        "o_orderkey",
        "customer",
        (F.col("amount") * 10000).cast("bigint").alias("amount"),
        F.coalesce("priority", F.lit("-")).alias("priority"),
        "deep.status",
        F.coalesce("deep.priority", F.lit("-")).alias("nested"),
        "day_partition",
        F.lit(f"{types['customer']} {types['amount']}").alias("types"),
    ).crossJoin(F.broadcast(past))


@query("""
SELECT 'failed' AS status, 'o_custkey' AS field, count(*) AS rows, 'bigint' AS type FROM orders
""")
def schema_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that would narrow a field fail their table by name; it keeps its rows and type."""
    run = options(spark, evolve=True, default_rule=MONTH_RULE)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    narrow = orders.withColumn("o_custkey", F.col("o_custkey").cast("int"))
    for rows in (orders, narrow):
        results = load.load_messages(spark, row_messages(rows, "orders"), MONTH, new_folder(spark, "landing"), run)
    name = f"{run.database_prefix}app.orders"
    error = load.report(spark, results).select(
        "status", F.regexp_extract("error", r"SchemaConflict: field (\w+) is", 1).alias("field")
    )
    kind = spark.table(name).schema["o_custkey"].dataType.simpleString()
    return error.crossJoin(spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.lit(kind).alias("type")))


@query("""
SELECT event_type AS tabela, count(*) AS n, count(DISTINCT event_id) AS events, CAST(sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY ALL
""")
def stream_append_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends of a stream's batches break off between two files and between two tables; the next run ends them."""
    folder, run = new_folder(spark, "stream"), options(spark, default_rule=EVENT_RULE)
    sent = event_messages(spark, sf_dir, keys="event_id")
    sent.write.parquet(f"{folder}/hub")
    hub = read_message_stream(spark, "parquet", {}, path=f"{folder}/hub", schema=sent.schema)
    streams.finish(streams.land_stream(hub, f"{folder}/landing", f"{folder}/checkpoint"))
    moved, whole = [], storage.rename_into

    def breaking(session, path, to):
        if len(moved) >= 5:
            raise OSError("the driver is lost")
        moved.append(to)
        whole(session, path, to)

    storage.rename_into = breaking
    try:
        broken = load.load_batches(spark, f"{folder}/landing", MONTH, run)
    finally:
        storage.rename_into = whole
    if not any(r.status == "failed" for r in broken):
        raise AssertionError("nothing broke off")
    results = load.load_batches(spark, f"{folder}/landing", MONTH, run)
    return all_rows(spark, loaded(results), run, "event_id").groupBy("tabela").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("event_id").alias("events"),
        F.sum("event_id").alias("ids"),
    )


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey * 4 >= 3 * top THEN 'Z' ELSE o_orderstatus END AS o_orderstatus,
       CAST(strftime(CASE WHEN o_orderkey * 4 >= 3 * top AND o_orderkey % 9 = 0
                          THEN o_orderdate + INTERVAL 400 DAY ELSE o_orderdate END, '%Y') AS INT) AS year_partition,
       true AS spared
FROM orders, (SELECT max(o_orderkey) AS top FROM orders)
""")
def merge_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive in four loads by key; updates of the newest are looked for in files that may hold them only."""
    rule = PartitionRule("o_orderdate", {"year_partition": "yyyy"}, as_type="int")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    top = orders.agg(F.max("o_orderkey")).first()[0]
    quarter = F.least(F.lit(3), F.floor(F.col("o_orderkey") * 4 / top))
    name = new_table(spark, with_rule(orders.filter(quarter == 0), rule), rule.names)
    for number in (1, 2, 3):
        tables.save(with_rule(orders.filter(quarter == number), rule), name, "append")
    newest = orders.filter(F.col("o_orderkey") * 4 >= 3 * top).withColumn("o_orderstatus", F.lit("Z"))
    moved = F.when(F.col("o_orderkey") % 9 == 0, F.col("o_orderdate") + F.expr("INTERVAL 400 DAYS")).otherwise(F.col("o_orderdate"))
    updates = with_rule(newest.withColumn("o_orderdate", moved), rule)
    asked = key_index.candidate_files(spark, name, ["o_orderkey"], updates)
    spared = 0 < len(asked) < len(spark.table(name).inputFiles())
    upsert(spark, updates, name, ["o_orderkey"], index=True)
    return spark.table(name).select("o_orderkey", "o_orderstatus", "year_partition", F.lit(spared).alias("spared"))


@query("""
SELECT CAST(year(o_orderdate) AS INT) AS year_partition, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS ids,
       4::BIGINT AS files_before, 2::BIGINT AS files_after, true AS large_file_kept
FROM orders GROUP BY ALL
""")
def compact_small_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One large and three small files a year: the small ones are packed, the large one stays the same file."""
    rule = PartitionRule("o_orderdate", {"year_partition": "yyyy"}, as_type="int")
    orders = with_rule(read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), rule)
    load_of = F.greatest(F.lit(0), F.pmod(F.xxhash64("o_orderkey"), F.lit(20)) - 16)
    name = new_table(spark, orders.filter(load_of == 0), rule.names)
    large = spark.table(name).select("year_partition", "_metadata.file_path", "_metadata.file_size").distinct()
    large = large.groupBy("year_partition").agg(F.max("file_path").alias("large"), F.max("file_size").alias("size"))
    large = [tuple(r) for r in large.collect()]  # one row per partition
    for number in (1, 2, 3):
        tables.save(orders.filter(load_of == number), name, "append")
    before = spark.createDataFrame(
        [tuple(r) for r in tables.file_counts(spark, name).select("year_partition", "files").collect()],
        "year_partition int, files_before bigint",
    )
    tables.compact(spark, name, target_bytes=2 * min(size for _, _, size in large))
    kept = spark.createDataFrame(large, "year_partition int, large string, size bigint")
    rows = spark.table(name).select("year_partition", "o_orderkey", F.col("_metadata.file_path").alias("file"))
    found = rows.join(kept, "year_partition").groupBy("year_partition").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("o_orderkey").alias("ids"),
        F.countDistinct("file").alias("files_after"),
        F.max(F.col("file") == F.col("large")).alias("large_file_kept"),
    )
    return found.join(before, "year_partition")


def _versioned_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """All orders by month in a table that keeps versions; they are version 1."""
    orders = with_rule(read(spark, sf_dir, "orders"), MONTH_RULE)
    name = new_table(spark, orders, MONTH_RULE.names)
    versions.enable(spark, name)
    return orders, name


@query("""
SELECT v AS version, CAST(year(o_orderdate) AS INT) AS year_partition, CAST(month(o_orderdate) AS INT) AS month_partition,
       count(*) AS n,
       CAST(sum(CASE WHEN v >= 2 AND year(o_orderdate) >= 1996 THEN 2 ELSE 1 END
                * CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
FROM orders, (VALUES (1), (2), (3)) versions(v)
WHERE (v = 1 OR year(o_orderdate) < 1996 OR o_orderstatus <> 'F') AND NOT (v = 3 AND year(o_orderdate) = 1995)
GROUP BY ALL
""")
def read_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 2 replaces the months since 1996 with dearer orders, version 3 all but 1995: each is read as it was."""
    orders, name = _versioned_orders(spark, sf_dir)
    dearer = orders.filter("o_orderstatus <> 'F' AND year_partition >= 1996")
    dearer = dearer.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    # Months left without a row by the filter lose their partition.
    months = versions.version(spark, name).places
    since = [p for p in months if int(versions.partition_values(p)["year_partition"]) >= 1996]
    versions.replace(dearer, name, emptied=since)
    tables.rebuild(spark.table(name).filter("year_partition <> 1995"), name, "")
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
    return reduce(
        DataFrame.unionAll,
        [
            versions.as_of(spark, name, v).groupBy(F.lit(v).alias("version"), *MONTH_RULE.names).agg(F.count(F.lit(1)).alias("n"), cents)
            for v in (1, 2, 3)
        ],
    )


@query("""
SELECT CAST(year(o_orderdate) AS INT) AS year_partition, CAST(month(o_orderdate) AS INT) AS month_partition, o_orderstatus,
       count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, year(o_orderdate) < 1997 AS file_kept
FROM orders WHERE year(o_orderdate) < 1997 OR o_orderpriority <> '1-URGENT' GROUP BY ALL
""")
def refresh_only_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by month; after orders since 1997 changed, only these months are built again and other files stay."""
    orders, origin = _versioned_orders(spark, sf_dir)
    folder = new_folder(spark, "app")
    target = Target(
        f"app_{uuid.uuid4().hex}.totals", f"{folder}/totals", partitions=MONTH_RULE.names, database_location=f"{folder}/db"
    )

    def build(origins):
        cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents")
        return origins[origin].groupBy("o_orderstatus", *MONTH_RULE.names).agg(F.count(F.lit(1)).alias("n"), cents)

    load.raise_on_failure([refresh_changed(spark, build, target, origin)])
    before = spark.table(target.name).select(F.col("_metadata.file_path").alias("file")).distinct()
    # Written down before they are replaced; its rows grow with the table's files.
    kept = new_folder(spark, "files")
    before.write.parquet(kept)
    since = [p for p in versions.version(spark, origin).places if int(versions.partition_values(p)["year_partition"]) >= 1997]
    versions.replace(orders.filter("year_partition >= 1997 AND o_orderpriority <> '1-URGENT'"), origin, emptied=since)
    load.raise_on_failure([refresh_changed(spark, build, target, origin)])
    now = spark.table(target.name).select("*", F.col("_metadata.file_path").alias("file"))
    known = spark.read.schema("file string").parquet(kept).withColumn("known", F.lit(True))
    return now.join(known, "file", "left").select(
        *MONTH_RULE.names, "o_orderstatus", "n", "cents", F.coalesce("known", F.lit(False)).alias("file_kept")
    )
