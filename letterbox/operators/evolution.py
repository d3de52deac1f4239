"""Schemas that grow from load to load: a lattice of types, and rows fitted to a grown table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.columns import quoted

# Integer types by size, and the digits that each holds.
_INTEGERS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


class SchemaConflict(ValueError):
    """A field whose type in the messages the table's type can't widen to."""


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether files written with ``old`` can be read as ``new`` without loss.

    These are the promotions that Spark's Parquet readers know, so nothing has
    to be rewritten: integers to larger ones, up to ``int`` to ``double``, any
    integer to a decimal with room for it, decimals that lose no digit on
    either side of the point, ``float`` to ``double``, dates to zoneless times.
    """
    a, b = old.simpleString(), new.simpleString()
    if a == b:
        return True
    if a in _INTEGERS:
        if b in _INTEGERS:
            return _INTEGERS[a] < _INTEGERS[b]
        if isinstance(new, T.DecimalType):
            # Files hold the smaller integers in 32 bits, which read as ten digits.
            return new.precision - new.scale >= (20 if a == "bigint" else 10)
        return b == "double" and a != "bigint"
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return (a, b) in {("float", "double"), ("date", "timestamp_ntz")}


def _joined(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    if old.simpleString() == new.simpleString():
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return evolved(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_joined(old.elementType, new.elementType, f"{name}.element"))
    if isinstance(old, T.MapType) and isinstance(new, T.MapType) and old.keyType == new.keyType:
        return T.MapType(old.keyType, _joined(old.valueType, new.valueType, f"{name}.value"))
    if widens(old, new):
        return new
    raise SchemaConflict(f"field {name} is {old.simpleString()} in the table and {new.simpleString()} in the messages")


def evolved(stored: T.StructType, sent: T.StructType, prefix: str = "") -> T.StructType:
    """The stored fields in their order, widened where the sent ones are wider, then the new ones.

    Names are compared as the catalog does, without case. A stored field that
    is not sent stays. A sent field that is narrower, or of another kind, raises.
    """
    fields = {f.name.lower(): f for f in stored.fields}
    for f in sent.fields:
        known = fields.get(f.name.lower())
        if known is None:
            fields[f.name.lower()] = T.StructField(f.name, f.dataType, True)
        else:
            fields[f.name.lower()] = T.StructField(known.name, _joined(known.dataType, f.dataType, prefix + f.name), True)
    return T.StructType(list(fields.values()))


def changes(old: T.StructType, new: T.StructType) -> tuple[list[str], list[str]]:
    """Top-level fields that ``new`` adds, and those whose type it changes."""
    known = {f.name.lower(): f.dataType.simpleString() for f in old.fields}
    added = [f.name for f in new.fields if f.name.lower() not in known]
    changed = [f.name for f in new.fields if known.get(f.name.lower(), f.dataType.simpleString()) != f.dataType.simpleString()]
    return added, changed


def fitted(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows in the columns of ``schema``: missing fields are NULL, nested ones too, narrower ones widened."""
    have = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for f in schema.fields:
        source = have.get(f.name.lower())
        column = F.lit(None).cast(f.dataType) if source is None else _fit(quoted(source.name), source.dataType, f.dataType)
        columns.append(column.alias(f.name))
    return df.select(columns)


def _fit(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if have.simpleString() == want.simpleString():
        return column
    if isinstance(want, T.StructType):
        known = {f.name.lower(): f for f in have.fields}
        fields = []
        for f in want.fields:
            source = known.get(f.name.lower())
            value = F.lit(None).cast(f.dataType) if source is None else _fit(column.getField(source.name), source.dataType, f.dataType)
            fields.append(value.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType):
        return F.transform(column, lambda x: _fit(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType):
        return F.transform_values(column, lambda _, x: _fit(x, have.valueType, want.valueType))
    return column.cast(want)
