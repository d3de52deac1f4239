"""From message bodies to envelopes and table specs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from ..functions.columns import key_names
from ..functions.schemas import REJECTED_BODY, envelope_schema, payload_schema
from ..model import TableSpec
from .evolution import widens


def parse_messages(
    messages: DataFrame,
    body: str = "body",
    *,
    payload: bool = True,
    keep_rejected: bool = False,
    header: bool = True,
) -> DataFrame:
    """Envelope columns of every message.

    Registry documents say ``id`` where messages say ``_id``; both count.
    ``payload=False`` skips the payload, which is most of a message, where
    only the header matters.  ``keep_rejected`` adds the text of bodies that
    do not fit the envelope.  ``header=False`` gives the payload, the
    destination's name and its quantity only, where no more is wanted: the
    other texts, which any value fits, are passed over.

    The parse sits in a generator because Spark would otherwise repeat it for
    every later filter it moves below a projection.
    """
    if not (payload or header):
        raise ValueError("neither payload nor header is wanted")
    fields = [f for f in envelope_schema().fields if payload or f.name != "conteudo"]
    wire = T.StructType(fields + [T.StructField("id", T.StringType())]) if header else T.StructType.fromDDL(_BARE_DDL)
    options = {}
    if keep_rejected:
        wire = wire.add(REJECTED_BODY, T.StringType())
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED_BODY}
    text = F.col(body).cast("string")
    parsed = F.from_json(text, wire, options)
    if not payload:
        return messages.select(F.inline(F.array(parsed))).select(*_one_id(wire))
    opened = messages.select(text.alias(_BODY), F.inline(F.array(parsed)))
    # As text a JSON number has the digits of a double. Payloads declared to hold decimals
    # are read from the body as a variant, which keeps all of them; no other body is read again.
    exact = F.try_variant_get(F.try_parse_json(_BODY), "$.conteudo", "variant").cast("string")
    declared = F.lower("destino.structType" if header else _spec_of(F.col(_BODY))).contains("decimal")
    if not header:
        declared = _may_say_decimal(F.col(_BODY)) & declared
    payload = F.when(declared, F.coalesce(exact, F.col("conteudo"))).otherwise(F.col("conteudo"))
    if not header:
        return opened.select("destino", payload.alias("conteudo"), *([REJECTED_BODY] if keep_rejected else []))
    columns = dict(zip(_one_id_names(wire), _one_id(wire))) | {"conteudo": payload.alias("conteudo")}
    return opened.select(*columns.values())


_BODY = "letterbox_body"

# The structs are looked into, as a body where one is none does not fit.
_BARE_DDL = """
    origem STRUCT<diretorio: STRING>, destino STRUCT<diretorio: STRING, quantidade: INT>, conteudo STRING
"""


def _spec_of(body: Column) -> Column:
    return F.from_json(body, "destino STRUCT<structType: STRING>")["destino"]["structType"]


def _may_say_decimal(body: Column) -> Column:
    """Never False for a body that declares one, be it written with escapes; the spec itself decides."""
    return F.lower(body).contains("decimal") | body.contains("\\u")


def _one_id_names(wire: T.StructType) -> list[str]:
    return ["_id", *[name for name in wire.names if name not in ("_id", "id")]]


def _one_id(wire: T.StructType) -> list[Column]:
    return [F.coalesce("_id", "id").alias("_id"), *[F.col(name) for name in _one_id_names(wire)[1:]]]


def has_rows() -> Column:
    """Envelopes announcing rows; a NULL quantity does not count."""
    return F.col("destino.quantidade") != 0


def is_rejected() -> Column:
    """Bodies that are no envelope, or envelopes that lead nowhere."""
    unnamed = F.coalesce("destino.diretorio", F.lit("")) == ""
    nowhere = F.col("destino").isNull() | (has_rows() & unnamed)
    return F.col(REJECTED_BODY).isNotNull() | F.coalesce(nowhere, F.lit(False))


def envelopes(
    messages: DataFrame, body: str = "body", *, payload: bool = True, header: bool = True
) -> DataFrame:
    """Parsed envelopes that announce rows; what ``quarantine`` returns is not among them."""
    parsed = parse_messages(messages, body, payload=payload, keep_rejected=True, header=header)
    return parsed.filter(has_rows() & ~is_rejected()).drop(REJECTED_BODY)


def quarantine(messages: DataFrame, body: str = "body") -> DataFrame:
    """Rejected messages with what could be read of them."""
    return parse_messages(messages, body, keep_rejected=True).filter(is_rejected())


def of_table(df: DataFrame, table: str) -> DataFrame:
    return df.filter(F.col("destino.diretorio") == F.lit(table))


def of_id(df: DataFrame, identifier: str) -> DataFrame:
    return df.filter(F.col("_id") == F.lit(identifier))


def tables(df: DataFrame) -> DataFrame:
    """Distinct destination tables."""
    return df.select(F.col("destino.diretorio").alias("diretorio")).distinct()


def resolve_specs(df: DataFrame) -> DataFrame:
    """One spec per destination: the newest, ties broken by the spec itself.

    Messages collapse to distinct specs inside each task first, with a numeric
    maximum that hash aggregation can hold, so a table with most of the
    messages shuffles no more than its distinct specs.
    """
    target = F.col("destino")
    spec = ["origem", "modo_gravacao", "caminho", "structType", "chave_tabela"]
    distinct = (
        df.select(
            target["diretorio"].alias("tabela"),
            F.coalesce("origem.fonte", F.lit("")).alias("origem"),
            F.lower(F.coalesce(target["modo_gravacao"], F.lit(""))).alias("modo_gravacao"),
            F.coalesce(target["caminho"], F.lit("")).alias("caminho"),
            F.coalesce(target["structType"], F.lit("")).alias("structType"),
            F.coalesce(target["chave_tabela"], F.lit("")).alias("chave_tabela"),
            F.unix_micros(F.col("timestamp").try_cast("timestamp")).alias("sent_at"),
        )
        .groupBy("tabela", *spec)
        .agg(
            F.coalesce(F.max("sent_at"), F.lit(-(2**63))).alias("sent_at"),
            F.count(F.lit(1)).alias("messages"),
        )
    )
    newest = F.max_by(F.struct(*spec), F.struct("sent_at", *spec))
    return (
        distinct.groupBy("tabela")
        .agg(
            newest.alias("spec"),
            F.count(F.lit(1)).alias("distinct_specs"),
            F.sum("messages").alias("messages"),
            F.sort_array(F.collect_set("structType")).alias("structTypes"),
        )
        .select("tabela", "spec.*", "distinct_specs", "messages", "structTypes")
    )


def united(newest: T.StructType, others: list[T.StructType]) -> T.StructType:
    """The newest fields, then those that only other specs have.

    A field of two types raises, unless the newest is the wider one.
    """
    fields = {f.name.lower(): f for f in newest.fields}
    for schema in others:
        for f in schema.fields:
            known = fields.setdefault(f.name.lower(), f)
            if known.dataType != f.dataType and not widens(f.dataType, known.dataType):
                raise ValueError(
                    f"field {f.name} is declared {known.dataType.simpleString()} and {f.dataType.simpleString()}"
                )
    return T.StructType(list(fields.values()))


def table_spec(row: Row, schemas: str = "union") -> TableSpec:
    """The newest spec; its schema takes in the fields of the window's other specs,
    unless ``schemas`` is ``newest``."""
    schema = payload_schema(row.structType)
    if schemas == "union":
        schema = united(schema, [payload_schema(t) for t in row.structTypes if t != row.structType])
    elif schemas != "newest":
        raise ValueError(f"schemas must be union or newest, not {schemas!r}")
    return TableSpec(
        source=row.origem,
        table=row.tabela,
        mode=row.modo_gravacao,
        path=row.caminho,
        schema=schema,
        keys=key_names(row.chave_tabela),
        distinct_specs=row.distinct_specs,
        messages=row.messages,
    )
