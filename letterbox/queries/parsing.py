"""Reading, header parsing and payload parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.cdn import CDN_FIELDS, CDN_LABELS, cdn_declared, cdn_schema, labelled
from ..functions.columns import key_list
from ..functions.dates import lookback_window, previous_day_window
from ..functions.schemas import declared_schema, payload_schema
from ..model import PartitionRule
from ..operators import envelopes as env
from ..operators.payload import expand, text_rows, typed_payload, typed_rows, with_day, with_rule
from ..operators.quality import cast_report, partition_counts
from ..session import new_folder
from ..sources.files import read_csv
from ..sources.hub import read_messages, select_window
from .producer import messages, row_messages
from .registry import query, read

EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> tuple[DataFrame, T.StructType]:
    events = read(spark, sf_dir, "events")
    sent = row_messages(events, F.col("event_type"), columns, enqueued=F.col("ts"))
    return sent, events.select(columns or events.columns).schema


@query("""
SELECT event_id, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
""")
def src_window_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    hub = new_folder(spark, "hub")
    sent, schema = _events(spark, sf_dir, EVENT_COLUMNS)
    sent.write.parquet(hub)
    window = previous_day_window("2024-01-11")
    return typed_payload(env.envelopes(read_messages(spark, "parquet", {}, window, path=hub)), schema)


@query("""
SELECT event_id, event_type FROM events
WHERE ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-11'
""", name="lookback_window")
def lookback_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _events(spark, sf_dir, ["event_id", "event_type"])
    window = lookback_window("2024-01-10", 7)
    return typed_payload(env.envelopes(select_window(sent, window)), schema)


@query("""
SELECT concat(event_type, '-app') AS header_id, event_type AS diretorio, count(*) AS n
FROM events GROUP BY ALL
""")
def header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, _ = _events(spark, sf_dir)
    return (
        env.parse_messages(sent, payload=False)
        .groupBy(F.col("_id").alias("header_id"), F.col("destino.diretorio").alias("diretorio"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("SELECT doc_id FROM labels WHERE toxic <> 1 AND quality <> 0")
def quantity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity is the quality flag, and missing for toxic documents."""
    labels = read(spark, sf_dir, "labels")
    quantity = F.when(F.col("toxic") != 1, F.col("quality"))
    sent = row_messages(labels, "labels", ["doc_id"], quantity=quantity)
    return typed_payload(env.envelopes(sent), labels.select("doc_id").schema)


@query("SELECT event_id, ts, value FROM events WHERE event_type = 'purchase'")
def id_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _events(spark, sf_dir, ["event_id", "ts", "value"])
    chosen = env.of_table(env.of_id(env.envelopes(sent), "purchase-app"), "purchase")
    return typed_payload(chosen, schema)


@query("SELECT DISTINCT event_type AS diretorio FROM events")
def table_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return env.tables(env.envelopes(_events(spark, sf_dir)[0], payload=False))


@query("""
SELECT source AS tabela, arg_max(lang, doc_id) AS chave_tabela, 'overwrite' AS modo_gravacao,
       count(DISTINCT lang) AS distinct_specs, CAST(count(*) AS BIGINT) AS messages
FROM documents GROUP BY source
""")
def spec_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of one destination disagree on the key; the newest counts."""
    documents = read(spark, sf_dir, "documents")
    sent_at = F.date_format(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ssXXX"
    )
    sent = row_messages(
        documents, F.col("source"), ["doc_id"], keys=F.col("lang"), mode="OVERWRITE", sent=sent_at
    )
    return env.resolve_specs(env.envelopes(sent, payload=False)).select(
        "tabela", "chave_tabela", "modo_gravacao", "distinct_specs", "messages"
    )


@query("""
SELECT p_partkey, concat(replace(p_brand, ' ', ''), '|', replace(p_type, ' ', '')) AS keys FROM part
""", name="key_list")
def key_list_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    text = F.concat("p_brand", F.lit(", "), "p_type", F.lit(",,"), "p_brand")
    return part.select("p_partkey", F.concat_ws("|", key_list(text)).alias("keys"))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def payload_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    schema = payload_schema(declared_schema(orders.schema))
    return typed_payload(env.envelopes(row_messages(orders, "orders"), header=False), schema)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, with every quote, control character and line break in them."""
    documents = read(spark, sf_dir, "documents")
    return typed_payload(env.envelopes(row_messages(documents, "documents")), documents.schema)


_MEASURES = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount"}


def _line_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, T.StructType]:
    """One message per order line, one payload element per measure of it."""
    lines = read(spark, sf_dir, "lineitem")
    elements = [
        F.struct("l_orderkey", "l_linenumber", "l_partkey", F.lit(name).alias("measure"), F.col(column).alias("amount"))
        for name, column in _MEASURES.items()
    ]
    schema = T.StructType.fromDDL(
        "l_orderkey BIGINT, l_linenumber INT, l_partkey BIGINT, measure STRING, amount DOUBLE"
    )
    return messages(lines, F.lit("lineitem"), F.array(*elements), schema), schema


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS measure, l_quantity AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'price', l_extendedprice FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 'discount', l_discount FROM lineitem
""")
def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _line_messages(spark, sf_dir)
    return typed_payload(env.envelopes(sent, header=False), schema)


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, 'quantity' AS measure, l_quantity AS amount FROM lineitem
""")
def payload_first_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _line_messages(spark, sf_dir)
    return typed_payload(env.envelopes(sent, header=False), schema, first_only=True)


@query("""
SELECT concat(event_type, '-app') AS header_id, '1.0.0' AS header_versao, 'lot' AS header_lote,
       'app' AS fonte, event_type AS diretorio, event_id, value FROM events
""")
def header_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _events(spark, sf_dir, ["event_id", "value"])
    rows = typed_rows(env.envelopes(sent), schema)
    return rows.select(
        "header_id",
        "header_versao",
        "header_lote",
        F.col("header_origem.fonte").alias("fonte"),
        F.col("header_destino.diretorio").alias("diretorio"),
        "event_id",
        "value",
    )


def _k_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k`` as text, spoiled with an ``x`` in every tenth value."""
    events = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    events = events.withColumn("k", F.when(k % 10 == 0, "x").otherwise(k.cast("string")))
    return row_messages(events, "events", ["event_id", "k"])


_K_DDL = "event_id BIGINT, k INT"


@query("""
SELECT event_id, CASE WHEN k % 10 = 0 THEN -1 ELSE k END AS k, k % 10 = 0 AS lost
FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
""")
def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = typed_payload(env.envelopes(_k_messages(spark, sf_dir)), T.StructType.fromDDL(_K_DDL))
    return rows.select(
        "event_id", F.coalesce("k", F.lit(-1)).alias("k"), F.col("k").isNull().alias("lost")
    )


@query("""
SELECT 'event_id' AS field, 'bigint' AS declared_type, count(*) AS present, 0::BIGINT AS failed FROM events
UNION ALL
SELECT 'k', 'int', count(*), count(*) FILTER (CAST(json_extract_string(props, '$.k') AS INT) % 10 = 0)
FROM events
""")
def cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType.fromDDL(_K_DDL)
    return cast_report(text_rows(env.envelopes(_k_messages(spark, sf_dir)), schema), schema)


@query("""
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INT) AS l_quantity,
       CAST(trunc(l_extendedprice) AS BIGINT) AS l_extendedprice FROM lineitem
""")
def legacy_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractional numbers bound for integer columns lose the fraction."""
    lines = read(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    lines = lines.withColumn("l_extendedprice", price)
    schema = T.StructType.fromDDL(
        "l_orderkey BIGINT, l_linenumber INT, l_quantity INT, l_extendedprice BIGINT"
    )
    sent = row_messages(lines, "lineitem", schema.names)
    return typed_payload(env.envelopes(sent), schema, legacy_cast=True)


@query("""
SELECT c_custkey, n_name AS geo_nation, r_name AS geo_region, n_nationkey AS geo_code
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def nested_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A struct field declared as DDL text, its numbers sent as text."""
    nation = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    element = F.struct(
        "c_custkey",
        F.struct(
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            F.col("n_nationkey").cast("string").alias("code"),
        ).alias("geo"),
    )
    declared = {
        "fields": [
            {"name": "c_custkey", "dataType": "long", "nullable": True, "metadata": {}},
            {"name": "geo", "dataType": "nation : string, region : string, code : integer", "nullable": True, "metadata": {}},
        ]
    }
    sent = messages(customers, F.lit("customer"), F.array(element), declared=declared)
    return expand(typed_payload(env.envelopes(sent), payload_schema(declared)), "geo", "geo_")


def _leaves() -> dict[str, dict[str, bool]]:
    """The record's structs with their leaves, and whether each is text."""
    declared = {
        name: [leaf.split(":") for leaf in fields.split(",")] for name, fields in CDN_FIELDS.items() if ":" in fields
    }
    return {name: {n.strip(): t.strip() == "string" for n, t in leaves} for name, leaves in declared.items()}


#: The leaf that carries a page's whole HTML.
_CDN_BODY = "message.queryStr"


def _cdn_sql() -> str:
    texts = {f"{name}.{leaf}": text for name, leaves in _leaves().items() for leaf, text in leaves.items()}
    columns = [
        "html" if path == _CDN_BODY else f"concat('{path}-', page_id)" if texts[path] else f"CAST(page_id + {len(path)} AS DOUBLE)"
        for path in CDN_LABELS.values()
    ]
    named = ", ".join(f'{c} AS "{label}"' for c, label in zip(columns, CDN_LABELS))
    return f"SELECT CAST(page_id AS VARCHAR) AS id, {named} FROM pages"


@query(_cdn_sql())
def cdn_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested access-log record with every leaf filled, under all its labels."""
    pages = read(spark, sf_dir, "pages")

    def leaf(path: str, text: bool):
        if path == _CDN_BODY:
            return F.col("html")
        if text:
            return F.concat(F.lit(f"{path}-"), F.col("page_id").cast("string"))
        return F.col("page_id") + len(path)

    structs = [
        F.struct(*[leaf(f"{name}.{n}", text).alias(n) for n, text in leaves.items()]).alias(name)
        for name, leaves in _leaves().items()
    ]
    element = F.struct(F.col("page_id").cast("string").alias("id"), *structs)
    sent = messages(pages, F.lit("cdn"), F.array(element), declared=cdn_declared())
    rows = typed_payload(env.envelopes(sent), cdn_schema())
    numbers = {f"{s}.{n}" for s, leaves in _leaves().items() for n, text in leaves.items() if not text}
    named = [
        c.cast("double").alias(label) if path in numbers else c
        for c, (label, path) in zip(labelled(rows), CDN_LABELS.items())
    ]
    return rows.select("id", *named)


@query("""
SELECT event_type AS diretorio, 2024 AS year_partition, 1 AS month_partition, 10 AS day_partition,
       count(*) AS n
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY event_type
""")
def partition_d1(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, schema = _events(spark, sf_dir)
    window = previous_day_window("2024-01-11")
    rows = with_day(typed_rows(env.envelopes(select_window(sent, window)), schema), window.day)
    return partition_counts(
        rows.withColumn("diretorio", F.col("header_destino.diretorio")),
        ["diretorio", "year_partition", "month_partition", "day_partition"],
    )


@query("""
SELECT strftime(o_orderdate, '%Y') AS year_partition, strftime(o_orderdate, '%m') AS month_partition,
       strftime(o_orderdate, '%d') AS day_partition, count(*) AS n FROM orders GROUP BY ALL
""")
def partition_from_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rows = typed_payload(env.envelopes(row_messages(orders, "orders")), orders.schema)
    rule = PartitionRule("conteudo.o_orderdate")
    return partition_counts(with_rule(rows, rule), rule.names)


@query("SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_schema_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    customers.write.option("header", True).csv(path)
    return read_csv(spark, path, customers.schema, header=True)
