"""Run windows and bookmarks: which slice of the source a run reads.

These are tiny driver-side computations on the run's clock and a few scalar
settings (never on data rows); the resulting bounds become pushed-down
predicates in ``tidewater.sources.scans``.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import time as TM

# Scheduling defaults of the source jobs.
REPLICATION_ZONE = "America/Lima"
TRAILING_MINUTES = 30
WATERMARK_LOOKBACK_SECONDS = 0
NPS_LOOKBACK_DAYS = 2
ADS_LOOKBACK_DAYS = 30
EXPORT_WEEKDAY = 1  # Tuesday (Monday = 0)


@dataclass(frozen=True)
class Window:
    start: datetime | None
    end: datetime | None


def _aware(now: datetime) -> datetime:
    return now if now.tzinfo else now.replace(tzinfo=timezone.utc)


def previous_local_day(now: datetime, zone: str = REPLICATION_ZONE) -> Window:
    """``(midnight D-1, midnight D]`` in ``zone``, as UTC wall-clock bounds."""
    local_now = _aware(now).astimezone(ZoneInfo(zone))
    today = datetime.combine(local_now.date(), time.min, tzinfo=ZoneInfo(zone))
    start = today - timedelta(days=1)
    return Window(TM.to_utc_naive(start), TM.to_utc_naive(today))


def trailing_minutes(now: datetime, minutes: int = TRAILING_MINUTES) -> Window:
    end = TM.to_utc_naive(_aware(now))
    return Window(end - timedelta(minutes=minutes), end)


def resolve_replication_window(
    now: datetime,
    watermark: datetime | None,
    explicit_start: datetime | None = None,
    explicit_end: datetime | None = None,
    previous_day: bool = False,
    fixed_minutes: int | None = None,
    zone: str = REPLICATION_ZONE,
    lookback_seconds: int = WATERMARK_LOOKBACK_SECONDS,
) -> Window:
    """Window of one replication run. Without explicit bounds, a previous-day
    or trailing-minutes schedule wins; otherwise the explicit start, else
    the watermark minus the lookback (the lookback never shifts an explicit
    start); the end is explicit or open."""
    if explicit_start is None and explicit_end is None:
        if previous_day:
            return previous_local_day(now, zone)
        if fixed_minutes:
            return trailing_minutes(now, fixed_minutes)
    start = explicit_start if explicit_start is not None else watermark
    if start is not None and explicit_start is None and lookback_seconds > 0:
        start = start - timedelta(seconds=lookback_seconds)
    return Window(
        TM.to_utc_naive(start) if start is not None else None,
        TM.to_utc_naive(explicit_end) if explicit_end is not None else None,
    )


@dataclass(frozen=True)
class DayWindow:
    start: date
    end: date
    full_refresh: bool = False

    @property
    def inverted(self) -> bool:
        return self.start > self.end


def bookmark_window(
    run_date: date,
    bookmark: date | None,
    lookback_days: int,
    explicit_start: date | None = None,
    explicit_end: date | None = None,
    full_refresh: bool = False,
) -> DayWindow:
    """Start = explicit, else ``max(run_date - lookback, bookmark)`` (the
    bookmark day itself is re-read); ``full_refresh`` only ignores the
    bookmark. End = explicit or the run date. An inverted window is
    returned as is: the caller loads nothing and still sets the bookmark."""
    start = explicit_start if explicit_start is not None else run_date - timedelta(days=lookback_days)
    if not full_refresh and explicit_start is None and bookmark is not None:
        start = max(start, bookmark)
    end = explicit_end if explicit_end is not None else run_date
    return DayWindow(start, end, full_refresh)


def weekly_window(today: date, weekday: int = EXPORT_WEEKDAY) -> tuple[date, date]:
    """Seven days ending on the latest ``weekday`` (today counts):
    ``[end - 7 days, end)``."""
    end = today - timedelta(days=(today.weekday() - weekday) % 7)
    return end - timedelta(days=7), end


def bookmark_value(bookmarks: DataFrame, stream: str, field: str) -> DataFrame:
    """The bookmark of one stream as a one-row DataFrame (use ``.scalar()``
    to apply it inside a plan)."""
    return bookmarks.filter((F.col("stream") == stream) & (F.col("field") == field)).agg(
        F.max("value").alias("value")
    )


def advance_bookmark(bookmarks: DataFrame, stream: str, field: str, end_date: date | str) -> DataFrame:
    """Upsert ``(stream, field) -> end_date`` unconditionally: even after a run
    with no rows, and even when it moves the bookmark backwards."""
    new = bookmarks.sparkSession.range(1).select(
        F.lit(stream).alias("stream"), F.lit(field).alias("field"), F.lit(str(end_date)).cast("date").alias("value")
    )
    kept = bookmarks.filter(~((F.col("stream") == stream) & (F.col("field") == field)))
    return kept.unionByName(new)
