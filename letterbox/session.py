"""What a job needs from its session: a shared folder, and small driver-made rows."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_root(spark.sparkContext.applicationId)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"letterbox-{application}-")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_root(spark)}/letterbox/{label}-{uuid.uuid4().hex}"


def adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"


def small_rows(spark: SparkSession, rows: list[dict], schema: pa.Schema) -> DataFrame:
    """A few rows made on the driver, such as a run's report; starts no Python worker."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema))
