"""Rows to messages and back again are the same rows."""

from __future__ import annotations

from datetime import date, datetime

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from letterbox.functions.schemas import declared_schema, payload_schema
from letterbox.operators import envelopes as env
from letterbox.operators.payload import typed_payload
from letterbox.queries.producer import messages, row_messages

DDL = "n INT, id BIGINT, text STRING, amount DOUBLE, exact DECIMAL(12,3), flag BOOLEAN, day DATE, at TIMESTAMP_NTZ, tags ARRAY<STRING>"

TEXT = st.text(st.characters(exclude_categories=["Cs"]), max_size=30)
ROW = st.tuples(
    st.none() | st.integers(-(2**63), 2**63 - 1),
    st.none() | TEXT,
    st.none() | st.floats(allow_nan=False, allow_infinity=False),
    st.none() | st.decimals(-(10**8), 10**8, places=3),
    st.none() | st.booleans(),
    st.none() | st.dates(date(1600, 1, 1), date(9999, 12, 31)),
    st.none() | st.datetimes(datetime(1600, 1, 1), datetime(9999, 12, 31)),
    st.none() | st.lists(TEXT, max_size=3),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=25))
def test_identity(spark, rows):
    schema = T.StructType.fromDDL(DDL)
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
    sent = row_messages(df, "anything")
    back = typed_payload(env.envelopes(sent), payload_schema(declared_schema(schema)))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_many_elements_in_one_message(spark):
    df = spark.createDataFrame([(0, [(1, "a"), (2, None)]), (1, []), (2, None)], "i INT, rows ARRAY<STRUCT<id: INT, text: STRING>>")
    schema = df.schema["rows"].dataType.elementType
    sent = messages(df, F.lit("t"), F.col("rows"), schema, quantity=F.lit(1))
    back = typed_payload(env.envelopes(sent), schema)
    assert sorted(map(tuple, back.collect()), key=repr) == [(1, "a"), (2, None), (None, None)]
