"""Read windows and day partitions, all in UTC and half-open."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Window:
    start: datetime
    end: datetime

    @property
    def day(self) -> date:
        """First day of the window, the partition of a one-day load."""
        return self.start.date()

    @property
    def start_ms(self) -> int:
        return int(self.start.timestamp() * 1000)

    @property
    def end_ms(self) -> int:
        return int(self.end.timestamp() * 1000)


def parse_day(text: str | date) -> date:
    """The day in UTC; a time without a zone counts as UTC. Raises on text left over."""
    at = datetime.fromisoformat(text.strip()) if isinstance(text, str) else text
    if not isinstance(at, datetime):
        return at
    return (at if at.tzinfo is None else at.astimezone(timezone.utc)).date()


def processing_text(trigger: datetime) -> str:
    """The processing date a scheduled run hands on: its trigger time minus one day."""
    return (trigger - timedelta(days=1)).strftime("%Y-%m-%d %H:%M:%S")


def _midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def previous_day_window(data_proc: str | date) -> Window:
    """The whole day before the processing date."""
    end = _midnight(parse_day(data_proc))
    return Window(end - timedelta(days=1), end)


def lookback_window(data_proc: str | date, init: int | str | date) -> Window:
    """``init`` days before ``data_proc``, or from the date ``init``; ``data_proc`` included."""
    last = _midnight(parse_day(data_proc))
    text = str(init).strip()
    if isinstance(init, int) or text.isdigit():
        start = last - timedelta(days=int(text))
    else:
        start = _midnight(parse_day(init))
    if start > last:
        raise ValueError(f"look-back start {start.date()} is after {last.date()}")
    return Window(start, last + timedelta(days=1))


def day_values(day: date) -> dict[str, int]:
    return {"year_partition": day.year, "month_partition": day.month, "day_partition": day.day}


def within(df: DataFrame, column: str, window: Window) -> Column:
    """``start <= column < end`` with literals of the column's own type.

    Same-typed literals keep the comparison free of casts, so the range
    reaches the file scan; the zone is spelled out, so the session time zone
    does not matter.
    """
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        def bound(at: datetime) -> Column:
            return F.lit(at.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    else:
        def bound(at: datetime) -> Column:
            return F.lit(at.strftime("%Y-%m-%d %H:%M:%S+00:00")).cast("timestamp")
    return (F.col(column) >= bound(window.start)) & (F.col(column) < bound(window.end))
