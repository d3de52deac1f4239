import uuid

import pytest
from pyspark.sql import functions as F, types as T

from letterbox import catalog
from letterbox.sinks import tables

PARTS = ["year_partition", "day_partition"]


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}.target"
    schema = T.StructType.fromDDL("id INT, `odd-name` STRING, year_partition INT, day_partition INT")
    tables.create_table(spark, name, schema, str(tmp_path / "data"), PARTS, database_location=str(tmp_path / "db"))
    return name


def rows(spark, *triples):
    df = spark.createDataFrame([(i, str(i), 2024, d) for i, d in triples], "id INT, odd STRING, year_partition INT, day_partition INT")
    return df.withColumnRenamed("odd", "odd-name")


def content(spark, name):
    return sorted((r.id, r.day_partition) for r in spark.table(name).collect())


def test_created_empty_and_described(spark, table):
    assert spark.table(table).count() == 0
    assert tables.partition_columns(spark, table) == PARTS
    described = {r.col_name: (r.data_type, r.is_partition) for r in catalog.describe(spark, table).collect()}
    assert described == {
        "id": ("int", False),
        "odd-name": ("string", False),
        "year_partition": ("int", True),
        "day_partition": ("int", True),
    }
    assert "PARTITIONED BY (year_partition, day_partition)" in catalog.show_create_table(spark, table)
    assert [r.tableName for r in catalog.show_tables(spark, table.split(".")[0]).collect() if not r.isTemporary] == ["target"]


def test_append_adds_and_overwrite_replaces_only_its_partitions(spark, table):
    first = rows(spark, (1, 1), (2, 1), (3, 2))
    assert tables.save(first, table, "append")["rows"] == 3
    tables.save(first, table, "append")
    assert len(content(spark, table)) == 6
    for _ in range(2):
        assert tables.save(rows(spark, (9, 1)), table, "overwrite")["rows"] == 1
        assert content(spark, table) == [(3, 2), (3, 2), (9, 1)]


def test_overwrite_from_the_table_itself(spark, table):
    tables.save(rows(spark, (1, 1), (2, 2)), table, "append")
    doubled = spark.table(table).filter("day_partition = 1").withColumn("id", F.col("id") * 10)
    tables.save(doubled, table, "overwrite")
    assert content(spark, table) == [(2, 2), (10, 1)]


def test_empty_day_is_cleared(spark, table):
    day = {"year_partition": 2024, "day_partition": 1}
    tables.save(rows(spark, (1, 1), (2, 2)), table, "append")
    nothing = rows(spark, (1, 1)).filter("id < 0")
    assert tables.save_day(nothing, table, day, "append") == 0
    assert content(spark, table) == [(1, 1), (2, 2)]
    assert tables.save_day(nothing, table, day, "overwrite") == 0
    assert content(spark, table) == [(2, 2)]


def test_columns_go_by_name_and_must_match(spark, table):
    shuffled = rows(spark, (5, 3)).select("day_partition", "odd-name", "year_partition", "id")
    tables.save(shuffled, table, "append")
    assert content(spark, table) == [(5, 3)]
    with pytest.raises(ValueError, match="odd-name"):
        tables.save(rows(spark, (1, 1)).drop("odd-name"), table, "append")
    with pytest.raises(ValueError, match="extra"):
        tables.save(rows(spark, (1, 1)).withColumn("extra", F.lit(1)), table, "append")
    with pytest.raises(ValueError, match="mode"):
        tables.save(rows(spark, (1, 1)), table, "merge")


def test_spread_without_adaptive_execution(spark, table):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = rows(spark, *[(i, 1) for i in range(200)])
        filled = tables.spread(df, PARTS).select(F.spark_partition_id().alias("p")).distinct().count()
        assert filled > 1
        assert tables.save(df, table, "append")["rows"] == 200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rebuild_drops_old_partitions_and_schema(spark, table, tmp_path):
    tables.save(rows(spark, (1, 1), (2, 2)), table, "append")
    other = spark.createDataFrame([(7, 5)], "other INT, day_partition INT")
    tables.rebuild(other, table, str(tmp_path / "data"), ["day_partition"])
    assert [tuple(r) for r in spark.table(table).collect()] == [(7, 5)]
    again = spark.createDataFrame([(8, 6)], "other INT, day_partition INT")
    tables.save(again, table, "overwrite")
    assert spark.table(table).count() == 2


def test_drop_keeps_files_and_register_reads_padded_text(spark, tmp_path):
    path, name = str(tmp_path / "files"), f"t_{uuid.uuid4().hex}.months"
    spark.createDataFrame([(1, "01"), (2, "12")], "id INT, month STRING").write.partitionBy("month").parquet(path)
    for _ in range(2):
        tables.register_partitioned(spark, name, path, {"month": "string"}, database_location=str(tmp_path / "db"))
        assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "01"), (2, "12")]
    tables.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)
    assert spark.read.parquet(path).count() == 2


def test_compaction_keeps_rows_and_leaves_other_partitions(spark, table):
    for i in range(4):
        tables.save(rows(spark, (i, 1), (i + 10, 2)), table, "append")
    before = content(spark, table)
    files = lambda: {r.f for r in spark.table(table).filter("day_partition = 1").select(F.input_file_name().alias("f")).collect()}
    assert len(files()) == 4
    assert tables.compact(spark, table, "day_partition = 1") == ["=2024/=1"]
    assert len(files()) == 1
    assert content(spark, table) == before
    kept = files()
    assert tables.compact(spark, table) == ["=2024/=2"]
    assert content(spark, table) == before and files() == kept
    assert tables.compact(spark, table) == []
    assert tables.compact(spark, table, target_bytes=1) == []  # no partition has more files than bytes
    with pytest.raises(Exception):
        tables.compact(spark, table, "id = 1")


def test_tables_made_elsewhere_are_not_wiped(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    spark.sql(f"CREATE TABLE {database}.t (id INT, part STRING) USING parquet PARTITIONED BY (part) LOCATION '{tmp_path}/t'")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, part STRING")
    tables.save(df, f"{database}.t", "append")
    tables.save(df.filter("id = 1"), f"{database}.t", "overwrite")
    assert spark.table(f"{database}.t").count() == 2
