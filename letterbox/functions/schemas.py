"""Schemas: the fixed envelope, and payload schemas that arrive as data."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import types as T

# Names and types of the envelope on the wire.
ENVELOPE_DDL = """
    _id STRING, versao STRING, unidade_negocio STRING, projeto STRING,
    descricao STRING, timestamp STRING,
    origem STRUCT<tipo: STRING, fonte: STRING, caminho: STRING, diretorio: STRING>,
    destino STRUCT<tipo: STRING, caminho: STRING, diretorio: STRING, chave_tabela: STRING,
                   modo_gravacao: STRING, structType: STRING, quantidade: INT>,
    conteudo STRING, lote STRING
"""

REJECTED_BODY = "rejected_body"
# No field of a payload; an element that is no object carries its text here.
REJECTED_ELEMENT = "rejected payload element"
TABLE_COLUMN = "header_destino_diretorio"


def envelope_schema() -> T.StructType:
    return T.StructType.fromDDL(ENVELOPE_DDL)


def landed_schema() -> T.StructType:
    """Envelope as it lies in the landing zone, partition column last."""
    return (
        envelope_schema()
        .add(REJECTED_BODY, T.StringType())
        .add(TABLE_COLUMN, T.StringType())
    )


def parse_type(declared: Any) -> T.DataType:
    """A type from its declared form: JSON object, type name, or DDL text.

    DDL text may be a bare column list (``city : string, lat : string``),
    which stands for a struct.
    """
    if isinstance(declared, str):
        return T.DataType.fromDDL(declared)
    kind = declared.get("type", "struct")
    if kind == "struct":
        return struct_from_fields(declared["fields"])
    if kind == "array":
        return T.ArrayType(parse_type(declared["elementType"]), declared.get("containsNull", True))
    if kind == "map":
        return T.MapType(
            parse_type(declared["keyType"]),
            parse_type(declared["valueType"]),
            declared.get("valueContainsNull", True),
        )
    raise ValueError(f"unknown declared type {declared!r}")


def struct_from_fields(fields: list[dict[str, Any]]) -> T.StructType:
    """Fields carry their type under ``dataType`` (or ``type``).

    Payload data is never guaranteed complete, so every field is nullable.
    """
    return T.StructType(
        [
            T.StructField(
                field["name"],
                parse_type(field["dataType"] if "dataType" in field else field["type"]),
                True,
                field.get("metadata") or None,
            )
            for field in fields
        ]
    )


def payload_schema(text: str | dict[str, Any]) -> T.StructType:
    """Payload schema from the ``structType`` of an envelope."""
    declared = json.loads(text) if isinstance(text, str) else text
    if isinstance(declared, str):
        declared = json.loads(declared)
    if isinstance(declared, list):
        declared = {"fields": declared}
    schema = parse_type(declared)
    if not isinstance(schema, T.StructType):
        raise ValueError("structType is not a struct")
    return schema


def declared_schema(schema: T.StructType) -> dict[str, Any]:
    """The inverse: the ``structType`` object a producer would send."""
    return {
        "fields": [
            {
                "name": field.name,
                "dataType": field.dataType.simpleString(),
                "nullable": True,
                "metadata": {},
            }
            for field in schema.fields
        ]
    }


def all_text(schema: T.StructType) -> T.StructType:
    """Same field names, every top-level field as text."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def text_leaves(dtype: T.DataType) -> T.DataType:
    """Same shape, every leaf as text, so that each leaf is cast on its own."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, text_leaves(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(text_leaves(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), text_leaves(dtype.valueType))
    return T.StringType()


def exact_leaves(dtype: T.DataType) -> T.DataType:
    """Same shape, every leaf as text but decimals, which JSON text would round to doubles."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, exact_leaves(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(exact_leaves(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(T.StringType(), exact_leaves(dtype.valueType))
    return T.VariantType() if isinstance(dtype, T.DecimalType) else T.StringType()


def pick(schema: T.StructType, names: list[str]) -> T.StructType:
    """The named fields only, in schema order; names are matched without case."""
    wanted = {name.lower() for name in names}
    return T.StructType([f for f in schema.fields if f.name.lower() in wanted])
