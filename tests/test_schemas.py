import json

import pytest
from pyspark.sql import types as T

from letterbox.functions import schemas
from letterbox.functions.cdn import CDN_LABELS, cdn_declared, cdn_schema, labelled
from letterbox.functions.columns import key_list, key_names, lenient_cast
from pyspark.sql import functions as F


def test_data_type_key_is_renamed_only_as_a_key(spark):
    text = json.dumps({"fields": [{"name": "dataType", "dataType": "integer"}, {"name": "my_dataType_x", "dataType": "date"}]})
    schema = schemas.payload_schema(text)
    assert schema.names == ["dataType", "my_dataType_x"]
    assert [f.dataType for f in schema] == [T.IntegerType(), T.DateType()]


def test_type_may_already_be_there(spark):
    fields = [{"name": "a", "type": "string"}]
    assert schemas.payload_schema({"type": "struct", "fields": fields}) == schemas.payload_schema({"fields": fields})


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("int", T.IntegerType()),
        ("integer", T.IntegerType()),
        ("bigint", T.LongType()),
        ("long", T.LongType()),
        ("short", T.ShortType()),
        ("float", T.FloatType()),
        ("double", T.DoubleType()),
        ("boolean", T.BooleanType()),
        ("binary", T.BinaryType()),
        ("date", T.DateType()),
        ("timestamp", T.TimestampType()),
        ("timestamp_ntz", T.TimestampNTZType()),
        ("decimal(10,2)", T.DecimalType(10, 2)),
        ("array<int>", T.ArrayType(T.IntegerType())),
        ({"type": "array", "elementType": "string", "containsNull": True}, T.ArrayType(T.StringType())),
        ({"type": "map", "keyType": "string", "valueType": "integer", "valueContainsNull": True}, T.MapType(T.StringType(), T.IntegerType())),
        ({"type": "struct", "fields": [{"name": "x", "dataType": "long"}]}, T.StructType([T.StructField("x", T.LongType())])),
    ],
)
def test_declared_types(spark, declared, expected):
    assert schemas.parse_type(declared) == expected


def test_struct_type_may_be_sent_as_text_or_bare_list(spark):
    fields = [{"name": "a", "dataType": "string"}]
    expected = schemas.payload_schema({"fields": fields})
    assert schemas.payload_schema(json.dumps(json.dumps({"fields": fields}))) == expected
    assert schemas.payload_schema(json.dumps(fields)) == expected


def test_unreadable_schema_fails(spark):
    with pytest.raises(Exception):
        schemas.payload_schema('{"fields": [{"name": "a", "dataType": "nonsense type"}]}')


def test_all_text_keeps_names(spark):
    schema = T.StructType.fromDDL("a INT, b STRUCT<c: INT>, `d-0` DATE")
    assert schemas.all_text(schema) == T.StructType.fromDDL("a STRING, b STRING, `d-0` STRING")


def test_cdn_record_shape(spark):
    schema = cdn_schema()
    structs = {f.name: len(f.dataType.fields) for f in schema if isinstance(f.dataType, T.StructType)}
    assert len(schema.fields) == 15
    assert structs == {"geo": 7, "message": 14, "netPerf": 10, "cache": 5, "waf": 19, "network": 5, "reqHdr": 22, "respHdr": 27}
    numbers = [
        f"{f.name}.{leaf.name}"
        for f in schema
        if f.name in structs
        for leaf in f.dataType
        if leaf.dataType == T.IntegerType()
    ]
    assert numbers == ["netPerf.netOriginLatency", "netPerf.clientRTT", "netPerf.midMileLatency", "waf.pRate"]
    assert schemas.payload_schema(json.dumps(cdn_declared())) == schema


def test_every_cdn_label_names_a_leaf(spark):
    df = spark.createDataFrame([], cdn_schema())
    assert df.select(labelled(df)).columns == list(CDN_LABELS)


@pytest.mark.parametrize("text, names", [("a, b,,c", ["a", "b", "c"]), ("", []), (None, []), ("north, north, south", ["north", "south"])])
def test_key_list(spark, text, names):
    df = spark.createDataFrame([(text,)], "k string")
    assert df.select(key_list(F.col("k")).alias("k")).first().k == names
    assert list(key_names(text)) == names


@pytest.mark.parametrize(
    "text, dtype, strict, legacy",
    [
        ("12", "int", 12, 12),
        ("1.9", "int", None, 1),
        ("-7.", "int", None, -7),
        ("x", "int", None, None),
        ("99999999999", "int", None, None),
        ("1.5", "double", 1.5, 1.5),
        (None, "int", None, None),
        ("true", "boolean", True, True),
        ('{"a":"1","b":"x"}', "struct<a:int,b:int>", (1, None), (1, None)),
        ('["1","q",3]', "array<int>", [1, None, 3], [1, None, 3]),
        ('{"k":"5"}', "map<string,int>", {"k": 5}, {"k": 5}),
    ],
)
def test_lenient_cast(spark, text, dtype, strict, legacy):
    df = spark.createDataFrame([(text,)], "v string")
    target = T.DataType.fromDDL(dtype)
    row = df.select(lenient_cast(F.col("v"), target).alias("s"), lenient_cast(F.col("v"), target, legacy=True).alias("l")).first()
    assert (row.s, row.l) == (strict, legacy)
