"""From envelopes to typed, partitioned rows of one table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions.columns import date_parts, lenient_cast, quoted, rejected_elements, text_elements, utc_time
from ..functions.dates import day_values
from ..functions.schemas import REJECTED_ELEMENT, all_text
from ..model import PartitionRule

# Header columns of every raw table and where they come from.
HEADER_COLUMNS = {
    "header_id": "_id",
    "header_versao": "versao",
    "header_unidade_negocio": "unidade_negocio",
    "header_projeto": "projeto",
    "header_descricao": "descricao",
    "header_timestamp": "timestamp",
    "header_origem": "origem",
    "header_destino": "destino",
    "header_lote": "lote",
}

_PAYLOAD, _REJECTED = "payload_element", "payload_rejected"


def header_columns() -> list[Column]:
    return [F.col(source).alias(name) for name, source in HEADER_COLUMNS.items()]


def text_rows(df: DataFrame, schema: T.StructType, *, first_only: bool = False) -> DataFrame:
    """One row per readable payload element: header columns plus fields as text.

    The whole array is read, lists within it too; an empty one gives one row of
    NULLs.  What is no object is left to ``payload_rejects``.  ``first_only``
    keeps just the first element of each message.
    """
    return _readable(df, schema, first_only).select(
        *header_columns(),
        *[F.col(_PAYLOAD).getField(f.name).alias(f.name) for f in schema.fields],
    )


def typed_rows(
    df: DataFrame,
    schema: T.StructType,
    *,
    first_only: bool = False,
    legacy_cast: bool = False,
    counted: Observation | None = None,
) -> DataFrame:
    """``text_rows`` with every field cast to its declared type.

    ``counted`` sees the number of rejected elements as ``rejected``, within the job that reads the rows.
    """
    return _readable(df, schema, first_only, counted).select(
        *header_columns(), *_typed_fields(schema, legacy_cast)
    )


def typed_payload(
    df: DataFrame, schema: T.StructType, *, first_only: bool = False, legacy_cast: bool = False
) -> DataFrame:
    """Payload fields alone; ``schema`` may be a subset, and only it is parsed."""
    return _readable(df, schema, first_only).select(_typed_fields(schema, legacy_cast))


def payload_rejects(df: DataFrame, schema: T.StructType, *, first_only: bool = False) -> DataFrame:
    """Elements that are no object, payloads that are no JSON, and missing payloads:
    message id and time, and their text."""
    bad = _elements(df, schema, first_only).filter(F.col(_REJECTED).isNotNull())
    return bad.select(
        F.col("_id").alias("header_id"),
        F.col("timestamp").alias("header_timestamp"),
        F.col(_REJECTED).alias("rejected_element"),
    )


def _readable(
    df: DataFrame, schema: T.StructType, first_only: bool, counted: Observation | None = None
) -> DataFrame:
    elements = _elements(df, schema, first_only)
    if counted is not None:
        elements = elements.observe(counted, F.count_if(F.col(_REJECTED).isNotNull()).alias("rejected"))
    return elements.filter(F.col(_REJECTED).isNull())


def _elements(df: DataFrame, schema: T.StructType, first_only: bool) -> DataFrame:
    """One row per element, with the text of those that can't be read.

    Arrays of objects, nearly all payloads, are parsed once, straight to their
    fields.  Only others are taken apart element by element.
    """
    payload = F.when(F.trim("conteudo") != "", F.col("conteudo")).otherwise("no payload")
    text = all_text(schema)
    elements = F.coalesce(text_elements(payload, text, schema), rejected_elements(payload, text, schema))
    # An empty array has no position; an element that is null has one.
    spread = df.select("*", F.posexplode_outer(elements).alias("payload_position", _PAYLOAD))
    if first_only:
        spread = spread.filter(F.coalesce("payload_position", F.lit(0)) == 0)
    bad = F.when(
        F.col("payload_position").isNotNull() & F.col(_PAYLOAD).isNull(), F.lit("null")
    ).otherwise(F.col(_PAYLOAD).getField(REJECTED_ELEMENT))
    return spread.withColumn(_REJECTED, bad)


def _typed_fields(schema: T.StructType, legacy_cast: bool) -> list[Column]:
    return [
        lenient_cast(F.col(_PAYLOAD).getField(f.name), f.dataType, legacy_cast).alias(f.name)
        for f in schema.fields
    ]


def with_day(df: DataFrame, day: date) -> DataFrame:
    """Constant partition columns of a one-day load."""
    return df.withColumns(
        {name: F.lit(value).cast("int") for name, value in day_values(day).items()}
    )


def rule_source(rule: PartitionRule) -> str:
    """Payload column a rule reads; documents prefix it with the payload field."""
    return rule.source.removeprefix("conteudo.")


def with_rule(df: DataFrame, rule: PartitionRule) -> DataFrame:
    """Partition columns derived from a payload column."""
    name = rule_source(rule)
    if name not in df.columns:
        raise ValueError(f"partition source {name!r} is not a column of the payload")
    source, dtype = quoted(name), df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        dtype = T.DataType.fromDDL(rule.source_type)
        source = lenient_cast(source, dtype)
    return df.withColumns(date_parts(utc_time(source, dtype), dict(rule.columns), rule.as_type))


def expand(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """A struct column spread into top-level columns, optionally prefixed."""
    struct = df.schema[column].dataType
    fields = [
        quoted(column).getField(f.name).alias(f"{prefix}{f.name}" if prefix else f.name)
        for f in struct.fields
    ]
    return df.select(*[quoted(name) for name in df.columns if name != column], *fields)
