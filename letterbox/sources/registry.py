"""Ingestion documents: table specs and pull specs kept as JSON files."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import key_list
from ..model import DAY_PARTITIONS, LoadOptions, PartitionRule

# Field names of the ingestion documents.
_RULES = (
    "ARRAY<STRUCT<de: STRUCT<nome_coluna: STRING, tipo: STRING>, "
    "para: STRUCT<" + ", ".join(f"{name}: STRING" for name in DAY_PARTITIONS) + ">>>"
)
DOCUMENT_DDL = f"""
    _id STRING, id STRING, unidade_negocio STRING, fonte STRING, projeto STRING, descricao STRING,
    origem STRUCT<
        configuracao_servidor: STRUCT<tipo: STRING, nome: STRING, sistema: STRING>,
        tabela: STRING, chave_tabela: STRING, query: STRING, fonte: STRING>,
    destino STRUCT<
        configuracao_servidor: STRUCT<tipo: STRING, nome: STRING, topico: STRING,
                                      client_id: STRING, group_id: STRING>,
        configuracao_particao: {_RULES}, particao: {_RULES},
        caminho: STRING, diretorio: STRING, chave_tabela: STRING, modo_gravacao: STRING,
        structType: STRING>,
    transformacao STRUCT<tipo: STRING, nome: STRING>
"""


def read_documents(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Raw ingestion documents, one per file or one per line."""
    return (
        spark.read.option("multiLine", multi_line)
        .schema(T.StructType.fromDDL(DOCUMENT_DDL))
        .json(path)
    )


def table_registry(documents: DataFrame) -> DataFrame:
    """One row per document, with both document kinds in the same columns."""
    origin, target = F.col("origem"), F.col("destino")
    return documents.select(
        F.coalesce("_id", "id").alias("documento"),
        F.coalesce(target["diretorio"], origin["tabela"]).alias("tabela"),
        F.coalesce("fonte", origin["fonte"]).alias("fonte"),
        F.lower(target["modo_gravacao"]).alias("modo_gravacao"),
        key_list(F.coalesce(target["chave_tabela"], origin["chave_tabela"])).alias("chaves"),
        origin["query"].alias("query"),
        target["configuracao_servidor"]["topico"].alias("topico"),
        F.when(F.size(target["configuracao_particao"]) > 0, target["configuracao_particao"])
        .otherwise(target["particao"])
        .alias("particoes"),
        target["structType"].alias("structType"),
    )


def partition_rules(registry: DataFrame, tables: list[str]) -> dict[str, PartitionRule]:
    """Declared partition rules of the given tables, for a load's options."""
    rows = registry.filter(F.col("tabela").isin(tables) & (F.size("particoes") > 0)).select("tabela", "particoes")
    rules: dict[str, PartitionRule] = {}
    for row in rows.toLocalIterator():  # one row per document asked for
        found = [
            PartitionRule(rule.de.nome_coluna, {k: v for k, v in rule.para.asDict().items() if v}, rule.de.tipo)
            for rule in row.particoes
        ]
        if len(found) > 1 or rules.get(row.tabela, found[0]) != found[0]:
            raise ValueError(f"table {row.tabela}: {len(found)} partition rules declared, or documents disagree")
        rules[row.tabela] = found[0]
    return rules


def registry_options(registry: DataFrame, tables: list[str], options: LoadOptions) -> LoadOptions:
    """A load's options with the partition rules, keys and write modes that documents declare.

    One row per document asked for reaches the driver.
    """
    rows = registry.filter(F.col("tabela").isin(tables)).select("tabela", "modo_gravacao", "chaves").collect()
    keys: dict[str, tuple[str, ...]] = {}
    modes: dict[str, str] = {}
    for row in rows:
        for known, declared in ((keys, tuple(row.chaves or ())), (modes, row.modo_gravacao)):
            if declared and known.setdefault(row.tabela, declared) != declared:
                raise ValueError(f"table {row.tabela}: documents disagree")
    return replace(
        options,
        partition_rules={**options.partition_rules, **partition_rules(registry, tables)},
        declared_keys={**options.declared_keys, **keys},
        declared_modes={**options.declared_modes, **modes},
    )
