"""Tables that load side by side share a fairly scheduled cluster."""

import subprocess
import sys
import textwrap
from pathlib import Path

from letterbox.plans import load

SCRIPT = """
    import sys, time
    from types import SimpleNamespace
    from pyspark.sql import SparkSession
    from letterbox.model import LoadResult
    from letterbox.plans import load

    mode, pool = sys.argv[1:]
    spark = (
        SparkSession.builder.master("local[2]")
        .config("spark.ui.enabled", "false").config("spark.scheduler.mode", mode)
        .config("spark.sql.shuffle.partitions", "1").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if pool:
        spark.sparkContext.setLocalProperty(load.POOL, pool)
    names = ["a_hot", "small_1", "small_2", "small_3"]
    ended, pools = [], {}
    busy = "sum(length(sha2(sha2(sha2(CAST(id AS STRING), 512), 512), 512)))"

    def one(table):
        pools[table] = spark.sparkContext.getLocalProperty(load.POOL)
        if table == "a_hot":
            spark.range(0, 12_000_000, 1, 120).selectExpr(busy).collect()
        else:
            while not spark.sparkContext.statusTracker().getActiveJobsIds():
                time.sleep(0.05)
            spark.range(0, 100, 1, 2).selectExpr(busy).collect()
        ended.append(table)
        return LoadResult(table, "loaded")

    load.resolve_specs = lambda landed: spark.createDataFrame([(n, "app") for n in names], "tabela string, origem string")
    load.table_spec = lambda row, schemas: row.tabela
    options = SimpleNamespace(with_declared=lambda s: s, schemas="union", concurrent_tables=8, audit_table=None)
    results = load._load_each(spark, None, [], None, options, one)
    assert [r.status for r in results] == ["loaded"] * 4, results
    print(ended.index("a_hot"), *[pools[n] for n in names])
"""


def run(mode, pool=""):
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(SCRIPT), mode, pool], cwd=root, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.split()


def test_small_tables_end_before_a_hot_one():
    assert run("FAIR") == ["3", "load-a_hot", "load-small_1", "load-small_2", "load-small_3"]


def test_the_callers_pool_stays():
    assert run("FAIR", "nightly")[1:] == ["nightly"] * 4


def test_first_in_first_out_has_no_pools(spark):
    assert not load._pool_each(spark)
