"""Wrap rows of a plain table into the messages a producer would send."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.schemas import declared_schema
from ..sinks.publish import json_text

_DECLARED = (
    "STRUCT<fields: ARRAY<STRUCT<name: STRING, dataType: STRING, nullable: BOOLEAN, "
    "metadata: MAP<STRING, STRING>>>>"
)


def one_row(df: DataFrame, *columns: str) -> Column:
    """A payload holding just the row's own columns."""
    return F.array(F.struct(*(columns or df.columns)))


def messages(
    df: DataFrame,
    table: Column,
    payload: Column,
    schema: T.StructType | None = None,
    *,
    declared: dict | None = None,
    keys: Column | str = "",
    mode: Column | str = "append",
    quantity: Column | None = None,
    sent: Column | str = "2024-01-10T00:00:00",
    enqueued: Column | None = None,
    source: str = "app",
) -> DataFrame:
    """One message ``(body, enqueuedTime)`` per row of ``df``.

    ``schema`` describes a payload element; ``declared`` overrides how the
    envelope states it.
    """
    structure = F.from_json(F.lit(json.dumps(declared or declared_schema(schema))), _DECLARED)
    keys, mode, sent = (F.lit(v) if isinstance(v, str) else v for v in (keys, mode, sent))
    body = F.struct(
        F.concat(table, F.lit(f"-{source}")).alias("_id"),
        F.lit("1.0.0").alias("versao"),
        F.lit("unit").alias("unidade_negocio"),
        F.lit("project").alias("projeto"),
        F.lit("sample").alias("descricao"),
        sent.alias("timestamp"),
        F.struct(
            F.lit("json").alias("tipo"),
            F.lit(source).alias("fonte"),
            F.lit(source).alias("caminho"),
            table.alias("diretorio"),
        ).alias("origem"),
        F.struct(
            F.lit("json").alias("tipo"),
            F.lit(f"/raw/{source}").alias("caminho"),
            table.alias("diretorio"),
            keys.alias("chave_tabela"),
            mode.alias("modo_gravacao"),
            structure.alias("structType"),
            (F.size(payload) if quantity is None else quantity).alias("quantidade"),
        ).alias("destino"),
        payload.alias("conteudo"),
        F.lit("lot").alias("lote"),
    )
    when = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz") if enqueued is None else enqueued
    return df.select(json_text(body).cast("binary").alias("body"), when.alias("enqueuedTime"))


def row_messages(df: DataFrame, table: Column | str, columns: list[str] | None = None, **kwargs) -> DataFrame:
    """One message per row, the payload being the row."""
    table = F.lit(table) if isinstance(table, str) else table
    chosen = df.select(columns or df.columns).schema
    schema = None if "declared" in kwargs else chosen
    return messages(df, table, one_row(df, *chosen.names), schema, **kwargs)
