from datetime import date

import pytest
from tests.conftest import FIELDS, envelope
from letterbox.functions.schemas import payload_schema
from letterbox.model import PartitionRule
from letterbox.operators import envelopes as env
from letterbox.operators.payload import HEADER_COLUMNS, expand, text_rows, typed_payload, typed_rows, with_day, with_rule
from letterbox.operators.quality import NullKeyError, assert_keys, cast_report, key_null_report


def rows(df, fields=FIELDS, **kwargs):
    return [tuple(r) for r in typed_payload(df, payload_schema({"fields": fields}), **kwargs).collect()]


def test_all_elements_are_kept_and_numbers_may_be_quoted(messages):
    df = env.envelopes(messages(envelope(payload=[{"id": "1", "store": "a", "day": "2024-01-10"}, {"id": 2, "store": "b"}])))
    assert rows(df) == [(1, "a", date(2024, 1, 10)), (2, "b", None)]
    assert rows(df, first_only=True) == [(1, "a", date(2024, 1, 10))]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ([], [(None, None, None)]),
        ("", []),
        ("not json", []),
        ([{"id": 1}, 5, {"id": 2}], [(1, None, None), (2, None, None)]),
        ([[{"id": 1}], [{"id": 2}, None]], [(1, None, None), (2, None, None)]),
        ({"id": 7}, [(7, None, None)]),
        ([[{"id": 8}]], [(8, None, None)]),
        ([{"id": 1, "other": 3}], [(1, None, None)]),
        ([{"id": "x", "store": 5, "day": "bad"}], [(None, "5", None)]),
        ([{"store": 'q"\\\n\u0001é'}], [(None, 'q"\\\n\u0001é', None)]),
    ],
)
def test_payload_shapes(messages, payload, expected):
    assert rows(env.envelopes(messages(envelope(payload=payload, quantidade=1)))) == expected


def test_nested_fields_load_with_odd_names(messages):
    fields = [
        {"name": "apTags-0", "dataType": "string"},
        {"name": "geo", "dataType": "city : string, code : integer"},
        {"name": "tags", "dataType": {"type": "array", "elementType": "long", "containsNull": True}},
    ]
    df = env.envelopes(messages(envelope(payload=[{"apTags-0": "t", "geo": {"city": "c", "code": "4"}, "tags": [1, "2"]}], fields=fields)))
    typed = typed_payload(df, payload_schema({"fields": fields}))
    assert [tuple(r) for r in expand(typed, "geo", "geo_").collect()] == [("t", [1, 2], "c", 4)]


def test_header_columns_come_first(messages):
    df = typed_rows(env.envelopes(messages(envelope(payload=[{"id": 1}]))), payload_schema({"fields": FIELDS}))
    assert df.columns == [*HEADER_COLUMNS, "id", "store", "day"]
    assert df.first().header_destino.diretorio == "sales"


def test_partitions_constant_and_from_a_column(messages):
    df = typed_payload(env.envelopes(messages(envelope(payload=[{"id": 1, "store": "2024-03-04", "day": "2024-02-05"}]))), payload_schema({"fields": FIELDS}))
    assert tuple(with_day(df, date(2024, 1, 9)).first())[3:] == (2024, 1, 9)
    assert tuple(with_rule(df, PartitionRule("conteudo.day")).first())[3:] == ("2024", "02", "05")
    assert tuple(with_rule(df, PartitionRule("store", source_type="date", as_type="int")).first())[3:] == (2024, 3, 4)
    with pytest.raises(ValueError):
        with_rule(df, PartitionRule("conteudo.nothing"))


def test_key_report_and_gate(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "`a-0` int, b string")
    report = {r.key: (r.null_count, r.status) for r in key_null_report(df, ["a-0", "b"]).collect()}
    assert report == {"a-0": (1, "ERRO"), "b": (2, "ERRO")}
    assert key_null_report(df, []).count() == 0
    assert_keys(df, [])
    assert_keys(df.filter("b is not null"), ["a-0", "B"])
    with pytest.raises(NullKeyError, match="b .2."):
        assert_keys(df, ["b"])
    with pytest.raises(NullKeyError, match="zz"):
        assert_keys(df, ["zz"])


def test_cast_report_counts_losses(messages):
    df = env.envelopes(messages(envelope(payload=[{"id": "x", "day": "2024-01-01"}, {"id": "1.5"}, {"id": 3, "day": "?"}])))
    schema = payload_schema({"fields": FIELDS})
    text = text_rows(df, schema)
    assert {r.field: (r.present, r.failed) for r in cast_report(text, schema).collect()} == {"id": (3, 2), "day": (2, 1)}
    legacy = {r.field: r.failed for r in cast_report(text, schema, legacy_cast=True).collect()}
    assert legacy == {"id": 1, "day": 1}
