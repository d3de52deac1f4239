import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tests.conftest import envelope
from letterbox.sources import hub
from letterbox.sources.files import read_landing
from letterbox.sinks.landing import rejected
from letterbox.streaming import streams


def write_lines(folder, name, *records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records) + "\n")


def run(df, tmp_path, name="out"):
    query = streams.start(df, "parquet", str(tmp_path / f"{name}-checkpoint"), path=str(tmp_path / name))
    streams.finish(query, 60)
    return sorted(tuple(r) for r in df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name)).collect())


def test_json_lines_typed(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", {"id": 1, "name": "n"}, "no json", {"id": 2})
    schema = T.StructType.fromDDL("id BIGINT, name STRING")
    parsed = streams.parse_lines(streams.read_lines(spark, str(tmp_path / "in")), schema)
    assert parsed.isStreaming
    names = streams.typed(parsed, schema).select(F.coalesce("name", F.lit("-")).alias("name"))
    assert run(names, tmp_path) == [("-",), ("-",), ("n",)]
    with pytest.raises(TypeError):
        streams.typed(parsed, T.StructType.fromDDL("id STRING"))


def test_length_and_restart_from_checkpoint(spark, tmp_path):
    write_lines(tmp_path / "in", "a.txt", "abc")
    lines = streams.with_length(streams.read_lines(spark, str(tmp_path / "in")))
    assert run(lines, tmp_path) == [("abc", 3)]
    write_lines(tmp_path / "in", "b.txt", "de", "f")
    assert run(lines, tmp_path) == [("abc", 3), ("de", 2), ("f", 1)]


def test_csv_stream_with_interval_trigger(spark, tmp_path):
    write_lines(tmp_path / "in", "a.csv", "id,name,surname,gender", "1,a,b,c")
    schema = T.StructType.fromDDL("id STRING, name STRING, surname STRING, gender STRING")
    df = streams.read_csv(spark, str(tmp_path / "in"), schema)
    query = streams.start(df, "memory", str(tmp_path / "checkpoint"), name="csv_rows", every="3 seconds")
    try:
        query.processAllAvailable()
        assert [tuple(r) for r in spark.table("csv_rows").collect()] == [("1", "a", "b", "c")]
        with pytest.raises(TimeoutError):
            streams.finish(query, 0.2)
    finally:
        query.stop()


def test_batch_frames_are_no_streams(spark, tmp_path):
    with pytest.raises(ValueError):
        streams.start(spark.range(1), "console", str(tmp_path))


@pytest.mark.parametrize("salts", [1, 3])
def test_join_across_batches(spark, tmp_path, salts):
    left, right = tmp_path / "left", tmp_path / "right"
    write_lines(left, "a", {"id": "1", "name": "x"}, {"id": "2", "name": "y"}, {"id": "9", "name": "z"})
    write_lines(right, "a", {"id": "1", "surname": "s"}, {"id": "1", "surname": "s"}, {"id": "7", "surname": "t"})

    def side(folder, ddl):
        return streams.parse_lines(streams.read_lines(spark, str(folder)), T.StructType.fromDDL(ddl))

    joined = streams.join_streams(
        side(left, "id STRING, name STRING"), side(right, "id STRING, surname STRING"), "id", ["id", "name", "surname"], salts=salts
    )
    assert run(joined, tmp_path) == [("1", "x", "s")] * 2
    write_lines(right, "b", {"id": "2", "surname": "late"})
    write_lines(left, "b", {"id": "7", "name": "later"})
    assert run(joined, tmp_path) == [("1", "x", "s"), ("1", "x", "s"), ("2", "y", "late"), ("7", "later", "t")]


def test_state_partitions_hold_for_the_query_only(spark, tmp_path):
    left, right = tmp_path / "left", tmp_path / "right"
    write_lines(left, "a", {"id": "1", "name": "x"})
    write_lines(right, "a", {"id": "1", "surname": "s"})
    first = streams.parse_lines(streams.read_lines(spark, str(left)), T.StructType.fromDDL("id STRING, name STRING"))
    second = streams.parse_lines(streams.read_lines(spark, str(right)), T.StructType.fromDDL("id STRING, surname STRING"))
    joined = streams.join_streams(first, second, "id", ["id", "surname"])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    query = streams.start(joined, "console", str(tmp_path / "checkpoint"), state_partitions=5)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    streams.finish(query, 60)
    stores = [p for p in (tmp_path / "checkpoint" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(stores) == 5


def test_join_bounded_by_time(spark, tmp_path):
    left, right = tmp_path / "left", tmp_path / "right"
    write_lines(left, "a", {"id": "1", "at": "2024-01-01T10:00:00Z"})
    write_lines(right, "a", {"id": "1", "then": "2024-01-01T10:30:00Z"}, {"id": "1", "then": "2024-01-01T12:00:00Z"})

    def side(folder, ddl):
        return streams.parse_lines(streams.read_lines(spark, str(folder)), T.StructType.fromDDL(ddl))

    joined = streams.join_streams(
        side(left, "id STRING, at TIMESTAMP"), side(right, "id STRING, then TIMESTAMP"), "id", ["id", "then"],
        times=("at", "then"), delay="10 minutes", within="1 HOUR",
    )
    assert [r[0] for r in run(joined.select(F.date_format("then", "HH:mm").alias("t")), tmp_path)] == ["10:30"]


def test_messages_land_once_across_runs(spark, tmp_path, messages):
    source = str(tmp_path / "hub")
    schema = T.StructType.fromDDL("body BINARY")

    def land(**changes):
        stream = hub.read_message_stream(spark, "parquet", {}, path=source, schema=schema)
        assert dict(stream.dtypes)["body"] == "string"
        streams.finish(streams.land_stream(stream, str(tmp_path / "landing"), str(tmp_path / "checkpoint"), **changes), 60)
        return read_landing(spark, str(tmp_path / "landing"), fmt="parquet")

    messages(envelope("a", [{"id": 1}]), "broken").write.parquet(source)
    assert land().count() == 2
    messages(envelope("b", [{"id": 1}])).write.mode("append").parquet(source)
    landed = land(files_per_table=2)
    assert sorted(r.header_destino_diretorio or "-" for r in landed.collect()) == ["-", "a", "b"]
    assert rejected(landed).count() == 1


def timed_join(spark, folder, **changes):
    schema = "id BIGINT, name STRING, at TIMESTAMP"
    left = spark.readStream.schema(schema).json(str(folder / "left"))
    right = spark.readStream.schema(schema).json(str(folder / "right")).selectExpr("id", "name AS other", "at AS then")
    arguments = dict(times=("at", "then"), delay="1 minute", within="10 minutes", how="left") | changes
    return streams.join_streams(left, right, "id", ["name", "other"], **arguments)


def row(id, name, at):
    return {"id": id, "name": name, "at": at and f"2024-01-01T{at}:00Z"}


@pytest.mark.parametrize("salts", [1, 3])
def test_left_join_gives_each_row_once_its_time_is_over(spark, tmp_path, salts):
    until = datetime(2024, 1, 2, tzinfo=timezone.utc)

    def drop(number, left, right):
        write_lines(tmp_path / "left", f"{number}.json", *left)
        write_lines(tmp_path / "right", f"{number}.json", *right)
        df = timed_join(spark, tmp_path, salts=salts, until=until)
        query = streams.start(df, "parquet", str(tmp_path / "checkpoint"), path=str(tmp_path / "out"))
        streams.finish(query, 60)
        found = spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()
        return sorted(tuple(x or "-" for x in r) for r in found), streams.state_rows(query)

    first = [row(1, "a", "01:00"), row(1, "a", "01:00"), row(2, "b", "01:05"), row(3, "c", "03:00"), row(4, "t", None)]
    found, held = drop(1, first, [row(1, "x", "01:09"), row(1, "y", "00:51"), row(1, "z", "02:00"), row(3, "w", "03:00")])
    # Of repeated rows each has its matches; b's time is over, c's match may not be its last.
    pairs = [("a", "x"), ("a", "x"), ("a", "y"), ("a", "y"), ("b", "-"), ("c", "w"), ("t", "-")]
    assert found == pairs and held > 0
    found, held = drop(2, [row(None, "n", "04:00"), row(5, "d", "04:00")], [row(3, "v", "03:10"), row(None, "m", "04:00")])
    assert ("c", "v") in found
    closing = {"id": 0, "name": "end", "at": "2024-01-03T00:00:00Z"}
    found, held = drop(3, [closing], [closing])
    assert found == sorted([*pairs, ("c", "v"), ("d", "-"), ("n", "-")]) and held == 0


def test_left_join_needs_its_bounds(spark, tmp_path):
    for side in ("left", "right"):
        write_lines(tmp_path / side, "1.json", row(1, "a", "01:00"))
    with pytest.raises(ValueError, match="within"):
        timed_join(spark, tmp_path, within=None)
    with pytest.raises(ValueError, match="until"):
        timed_join(spark, tmp_path, how="inner", delay=None, until=datetime(2024, 1, 2))
    with pytest.raises(ValueError, match="kind"):
        timed_join(spark, tmp_path, how="full")
