"""Column expressions; all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from .schemas import REJECTED_ELEMENT, exact_leaves, text_leaves

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def key_list(keys: Column) -> Column:
    """Key names out of comma text: blanks gone, no empty or repeated names."""
    names = F.split(F.regexp_replace(F.coalesce(keys, F.lit("")), " ", ""), ",")
    return F.array_distinct(F.array_remove(names, ""))


def key_names(keys: str | None) -> tuple[str, ...]:
    """``key_list`` for a value already on the driver."""
    names = (keys or "").replace(" ", "").split(",")
    return tuple(dict.fromkeys(name for name in names if name))


def _exact(schema: T.StructType) -> set[str]:
    return {f.name for f in schema.fields if "decimal" in f.dataType.simpleString()}


def _read_type(text: T.StructType, exact: set[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, T.VariantType() if f.name in exact else f.dataType) for f in text.fields]
    ).add(REJECTED_ELEMENT, T.StringType())


def _as_text(element: Column, read: T.StructType, exact: set[str]) -> Column:
    fields = [
        (element.getField(f.name).cast("string") if f.name in exact else element.getField(f.name)).alias(f.name)
        for f in read.fields
    ]
    return F.when(element.isNotNull(), F.struct(*fields))


def text_elements(payload: Column, text: T.StructType, schema: T.StructType) -> Column:
    """The objects of a JSON array with their fields as text; NULL when any element is none.

    Fields that hold decimals are read as variants first: as text, JSON numbers
    would keep no more than double precision.
    """
    exact = _exact(schema)
    read = _read_type(text, exact)
    elements = F.from_json(payload, T.ArrayType(read))
    return F.transform(elements, lambda e: _as_text(e, read, exact)) if exact else elements


def rejected_elements(payload: Column, text: T.StructType, schema: T.StructType) -> Column:
    """The elements of any other payload, lists within it taken apart, each read on its own.

    What is no object carries its text; so does a payload that is no array.
    """
    exact = _exact(schema)
    read = _read_type(text, exact)
    parts = _element_texts(payload)
    for _ in range(2):
        parts = F.flatten(F.transform(parts, _list_or_element))
    parts = F.coalesce(parts, F.array(payload))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED_ELEMENT}

    def one(part: Column) -> Column:
        element = F.from_json(F.coalesce(part, F.lit("null")), read, options)
        return _as_text(element, read, exact) if exact else element

    return F.transform(parts, one)


def _element_texts(array: Column) -> Column:
    """Each element's own JSON, with all digits; without them where an object repeats a name."""
    exact = F.transform(F.from_json(array, T.ArrayType(T.VariantType())), lambda v: F.to_json(v))
    return F.coalesce(exact, F.from_json(array, T.ArrayType(T.StringType())))


def _list_or_element(part: Column) -> Column:
    return F.when(part.startswith("["), F.coalesce(_element_texts(part), F.array(part))).otherwise(F.array(part))


# A time of day with a zone behind it.
_ZONED = r":\d{2}.*?(Z|z|UTC|GMT|UT|[+-]\d{1,2}(:?\d{2}){0,2}|[A-Za-z]+/[A-Za-z_/]+)\s*$"


def instant(text: Column) -> Column:
    """Text to a point in time; without a zone it is UTC, whatever the session's zone."""
    day = F.concat(F.date_format(text.try_cast("date"), "yyyy-MM-dd"), F.lit(" 00:00:00Z"))
    zoned = F.when(text.rlike(_ZONED), text).when(text.contains(":"), F.concat(F.rtrim(text), F.lit("Z"))).otherwise(day)
    return zoned.try_cast("timestamp")


def lenient_cast(text: Column, dtype: T.DataType, legacy: bool = False) -> Column:
    """Text to ``dtype``; what cannot be read becomes NULL.

    Nested types are read from their JSON text with text leaves first, so a
    bad leaf costs only itself.  ``legacy`` drops the fraction of a number
    bound for an integer type instead of giving NULL.
    """
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, _NESTED):
        shape = exact_leaves(dtype) if "decimal" in dtype.simpleString() else text_leaves(dtype)
        parsed = F.from_json(text, shape)
        return parsed if shape == dtype else parsed.try_cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return text.cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return instant(text)
    if legacy and isinstance(dtype, T.IntegralType):
        text = F.regexp_replace(text, r"^(\s*[+-]?\d+)\.\d*\s*$", "$1")
    return text.try_cast(dtype)


def date_parts(column: Column, patterns: dict[str, str], as_type: str = "string") -> dict[str, Column]:
    """One column per pattern, zero-padded text or cast to ``as_type``."""
    return {
        name: F.date_format(column, pattern).cast(as_type) for name, pattern in patterns.items()
    }


def utc_time(column: Column, dtype: T.DataType) -> Column:
    """A time as a clock in UTC shows it, whatever the session's zone; dates and zoneless times as they are."""
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
    return column


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")
