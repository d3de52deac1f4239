"""A corpus pipeline out of the operators of ``letterbox.llm``: judge, deduplicate, mix, pack.

Each stage takes the documents its predecessor kept and returns the rows that
stay, with the columns of documents; the last one returns their pieces with
their places in training sequences. What a stage does with NULLs, empty texts,
repeated rows, empty tables and other columns is what its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from letterbox.llm import exact_dedup, mixing, packing, quality_knn, simhash
from letterbox.llm.common import ID, saved
from letterbox.llm.queries import fit_quality, table, vocabulary


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at 0.3 or more."""
    return quality_knn.keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")), least=0.3)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs, shingle=4, distance=4, seed=42)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of underweight sources up to twice."""
    return mixing.mixed(docs, mixing.Mix(entropy=0.999, max_passes=2.0))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs, vocabulary(), 4096, 1), 4096).withColumnRenamed(ID, "doc_id")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_documents),
]

#: The classifier, the fingerprints and the tokens are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
