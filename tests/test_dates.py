from datetime import date, datetime, timezone

import pytest

from letterbox.functions.dates import day_values, lookback_window, previous_day_window, processing_text, within


def test_previous_day_is_the_whole_utc_day_before():
    window = previous_day_window("2024-03-01")
    assert window.start == datetime(2024, 2, 29, tzinfo=timezone.utc)
    assert window.end == datetime(2024, 3, 1, tzinfo=timezone.utc)
    assert window.day == date(2024, 2, 29)
    assert window.end_ms - window.start_ms == 86_400_000
    assert day_values(window.day) == {"year_partition": 2024, "month_partition": 2, "day_partition": 29}


@pytest.mark.parametrize("init, first", [(30, date(2023, 12, 11)), ("30", date(2023, 12, 11)), ("2024-01-10 00:00:00", date(2024, 1, 10)), (0, date(2024, 1, 10))])
def test_lookback_includes_the_processing_day(init, first):
    window = lookback_window("2024-01-10 12:30:00", init)
    assert window.day == first
    assert window.end == datetime(2024, 1, 11, tzinfo=timezone.utc)


def test_lookback_must_not_start_after_its_end():
    with pytest.raises(ValueError):
        lookback_window("2024-01-10", "2024-01-11")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_bounds_are_half_open_in_utc_whatever_the_session_zone(spark, kind, zone):
    suffix = "Z" if kind == "timestamp" else ""
    texts = ["2024-01-09T23:59:59.999999", "2024-01-10T00:00:00", "2024-01-10T23:59:59.999999", "2024-01-11T00:00:00"]
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t + suffix) for i, t in enumerate(texts)], "i int, t string")
        df = df.selectExpr("i", f"CAST(t AS {kind}) AS at")
        kept = df.filter(within(df, "at", previous_day_window("2024-01-11")))
        assert sorted(r.i for r in kept.collect()) == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_processing_text_is_the_trigger_minus_a_day():
    assert processing_text(datetime(2024, 3, 1, 5, 6, 7)) == "2024-02-29 05:06:07"
