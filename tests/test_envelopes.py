import json

from tests.conftest import FIELDS, envelope
from letterbox.operators import envelopes as env
from letterbox.sinks.landing import accepted, land, rejected
from letterbox.sources.files import read_landing


def test_header_fields_and_both_id_names(messages):
    first = envelope(payload=[{"id": 1}])
    second = envelope(payload=[{"id": 2}])
    second["id"] = second.pop("_id").replace("app", "reg")
    rows = env.parse_messages(messages(first, second)).collect()
    assert sorted(r._id for r in rows) == ["sales-app", "sales-reg"]
    assert rows[0].origem.fonte == "app"
    assert rows[0].destino.quantidade == 1
    assert json.loads(rows[0].destino.structType) == {"fields": FIELDS}
    assert json.loads(rows[0].conteudo) == [{"id": 1}]


def test_zero_and_missing_quantity_are_dropped(messages):
    kept = envelope(payload=[{"id": 1}], quantidade=1)
    df = env.envelopes(messages(kept, envelope(quantidade=0), envelope(quantidade=None)))
    assert df.count() == 1


def test_broken_bodies_go_to_quarantine(messages):
    python_text = str(envelope(payload=[{"id": None, "ok": True}]))
    quoted_quantity = envelope(quantidade="2")
    nowhere = envelope(table=None, payload=[{"id": 1}])
    unnamed = envelope(table="", payload=[{"id": 1}])
    broken = ["no json", "", None, python_text, quoted_quantity, nowhere, unnamed, {"a": 1}]
    good = envelope(payload=[{"id": 1}])
    assert env.quarantine(messages(good, envelope(quantidade=0), *broken)).count() == len(broken)


def test_newest_spec_counts_and_disagreement_is_reported(messages):
    old = envelope(payload=[{"id": 1}], timestamp="2024-01-10T08:00:00", modo_gravacao="append")
    new = envelope(payload=[{"id": 1}], timestamp="2024-01-10T09:00:00", modo_gravacao="OVERWRITE", chave_tabela=None)
    undated = envelope(payload=[{"id": 1}], timestamp="", caminho="/zzz")
    other = envelope("stock", payload=[{"id": 1}])
    specs = {r.tabela: r for r in env.resolve_specs(env.envelopes(messages(new, old, undated, old, other))).collect()}
    assert specs["sales"].modo_gravacao == "overwrite"
    assert specs["sales"].distinct_specs == 3
    assert specs["sales"].messages == 4
    assert specs["stock"].distinct_specs == 1
    spec = env.table_spec(specs["sales"])
    assert spec.keys == ()
    assert spec.full_name("raw_") == "raw_app.sales"
    assert spec.location("/lake/") == "/lake/raw/app/sales"
    assert env.table_spec(specs["stock"]).keys == ("id", "store")


def test_filters_by_id_and_table(messages):
    df = env.envelopes(messages(envelope("a", [{"id": 1}]), envelope("b", [{"id": 1}])))
    assert env.of_id(df, "a-app").count() == 1
    assert env.of_table(df, "b").count() == 1
    assert {r.diretorio for r in env.tables(df).collect()} == {"a", "b"}


def test_landing_keeps_null_columns_and_rejected_bodies(spark, messages, tmp_path):
    good = envelope("a", [{"id": 1}])
    good["lote"] = None
    for fmt in ("json", "parquet"):
        path = str(tmp_path / fmt)
        unnamed = envelope("", [{"id": 1}])
        land(messages(good, envelope("b", [{"id": 1}]), "broken", unnamed, envelope(quantidade=0)), path, fmt)
        landed = read_landing(spark, path, fmt=fmt)
        assert accepted(landed).count() == 2
        assert sorted(r.rejected_body or "-" for r in rejected(landed).collect()) == ["-", "broken"]
        one = read_landing(spark, path, "a", fmt).collect()
        assert len(one) == 1 and one[0].lote is None and one[0].destino.quantidade == 1
        land(messages(envelope("b", [{"id": 1}])), path, fmt)
        assert read_landing(spark, path, fmt=fmt).count() == 1


def test_payloads_without_headers_are_those_with_them(spark, messages):
    """Other texts are passed over; which bodies are rejected and how decimals are read stays."""
    amount = [{"name": "a", "dataType": "DECIMAL(24,4)", "nullable": True, "metadata": {}}]
    decimal = json.dumps(envelope("a", [], fields=amount, quantidade=1))
    exact = decimal.replace('"conteudo": []', '"conteudo": [{"a": 12345678901234567890.1234}]')
    assert exact != decimal
    found = messages(
        envelope("b", [{"id": 1}, {"id": 2}]),
        exact,
        exact.replace("DECIMAL", "\\u0064ecimal"),
        json.dumps(envelope("b", [{"id": 3}])) + "}",
        "broken",
        None,
        {**envelope("b", [{"id": 4}]), "origem": "app"},
        {**envelope("b", [{"id": 5}]), "destino": 7},
        {**envelope("b", [{"id": 6}]), "versao": {"x": [1]}},
        envelope("b", [{"id": 7}], quantidade="x"),
        envelope("", [{"id": 8}]),
        envelope("b", [], quantidade=0),
    )
    wide, bare = env.envelopes(found), env.envelopes(found, header=False)
    kept = sorted(r.conteudo for r in wide.collect())
    assert sorted(r.conteudo for r in bare.collect()) == kept
    assert sum("12345678901234567890.1234" in text for text in kept) == 2
    assert bare.columns == ["destino", "conteudo"] and bare.schema["destino"].dataType.names == ["diretorio", "quantidade"]
