"""Time expressions.

Convention: event times are ``TIMESTAMP_NTZ`` columns that hold UTC wall-clock
time (a ``TIMESTAMP`` column is accepted too). Local-calendar predicates such
as "the local day in America/Chicago" are never written as a function of the
column (that blocks Parquet pushdown); instead the two local midnights are
turned into UTC instants in Python and the raw column is range-filtered, so
both bounds reach the scan. DST days are 23 or 25 hours long, which is why
each midnight is resolved separately in the zone.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPOCH_NTZ = "1970-01-01 00:00:00"
# Integers at or above this value are epoch milliseconds, below it seconds.
MILLIS_THRESHOLD = 1_000_000_000_000


def _as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def local_midnight_utc(day: date | str, zone: str) -> datetime:
    """UTC wall-clock instant (naive) of local midnight of ``day`` in ``zone``."""
    local = datetime.combine(_as_date(day), time.min, tzinfo=ZoneInfo(zone))
    return local.astimezone(timezone.utc).replace(tzinfo=None)


def local_day_bounds_utc(start: date | str, end: date | str, zone: str) -> tuple[datetime, datetime]:
    """``[start, end)`` local dates as a half-open UTC instant range."""
    return local_midnight_utc(start, zone), local_midnight_utc(end, zone)


def to_utc_naive(value: datetime) -> datetime:
    """Aware datetimes are converted to UTC; naive ones are taken as UTC."""
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def ts_literal(value: datetime | str, data_type: T.DataType | None = None) -> Column:
    """A constant comparable with ``data_type`` without session-zone drift.

    For ``TIMESTAMP_NTZ`` the literal is the UTC wall-clock value; for
    ``TIMESTAMP`` it is the same instant, spelled with an explicit ``Z``.
    """
    if isinstance(value, datetime):
        value = to_utc_naive(value).isoformat(sep=" ")
    if isinstance(data_type, T.TimestampType):
        return F.lit(value + "Z").cast(T.TimestampType())
    return F.lit(value).cast(T.TimestampNTZType())


def instant_range(
    col: Column,
    lo: datetime | None,
    hi: datetime | None,
    data_type: T.DataType | None = None,
    closed: str = "left",
) -> Column:
    """Range predicate on a raw timestamp column.

    ``closed`` picks the bound convention: ``left`` = ``[lo, hi)`` (day and
    week curation), ``right`` = ``(lo, hi]`` (replication windows),
    ``both`` = ``[lo, hi]``. A missing bound is open.
    """
    cond = F.lit(True)
    if lo is not None:
        lit_lo = ts_literal(lo, data_type)
        cond = cond & (col > lit_lo if closed == "right" else col >= lit_lo)
    if hi is not None:
        lit_hi = ts_literal(hi, data_type)
        cond = cond & (col < lit_hi if closed == "left" else col <= lit_hi)
    return cond


def local_date_filter(
    col: Column,
    start: date | str,
    end: date | str,
    zone: str,
    data_type: T.DataType | None = None,
) -> Column:
    """``DATE(col, zone) >= start AND DATE(col, zone) < end``, pushed-down form."""
    lo, hi = local_day_bounds_utc(start, end, zone)
    return instant_range(col, lo, hi, data_type, closed="left")


def epoch_seconds_ntz(col: Column) -> Column:
    """Epoch seconds of a UTC wall-clock ``TIMESTAMP_NTZ`` (whole seconds, floored)."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), col)
    return F.floor(micros / F.lit(1_000_000)).cast("bigint")


UNIX_MILLIS_SQL = (
    "CAST(FLOOR(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col}) / 1000) AS BIGINT)"
)


def unix_millis_ntz(col: Column) -> Column:
    """``UNIX_MILLIS``: epoch milliseconds, sub-millisecond part floored."""
    micros = F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), col)
    return F.floor(micros / F.lit(1000)).cast("bigint")


def seconds_to_ntz(col: Column) -> Column:
    """``DATETIME(TIMESTAMP_SECONDS(CAST(c AS INT64)))`` as ``TIMESTAMP_NTZ``."""
    return F.timestamp_add("SECOND", col.cast("bigint"), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def millis_to_ntz(col: Column) -> Column:
    return F.timestamp_add("MILLISECOND", col.cast("bigint"), F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def epoch_auto_unit(col: Column) -> Column:
    """Integer epoch to timestamp: ``>= 1e12`` is milliseconds, else seconds;
    NULL stays NULL."""
    return (
        F.when(col.isNull(), F.lit(None).cast("timestamp_ntz"))
        .when(col >= F.lit(MILLIS_THRESHOLD), millis_to_ntz(col))
        .otherwise(seconds_to_ntz(col))
    )


def epoch_auto_unit_range(col: Column, lo: datetime, hi: datetime) -> Column:
    """``epoch_auto_unit(col)`` in ``[lo, hi)``, written on the raw integer
    so Parquet can push each unit's range down."""
    lo_s = int((lo - datetime(1970, 1, 1)).total_seconds())
    hi_s = int((hi - datetime(1970, 1, 1)).total_seconds())
    millis = (col >= F.lit(MILLIS_THRESHOLD)) & (col >= F.lit(lo_s * 1000)) & (col < F.lit(hi_s * 1000))
    seconds = (col < F.lit(MILLIS_THRESHOLD)) & (col >= F.lit(lo_s)) & (col < F.lit(hi_s))
    return millis | seconds


def millis_local_date_filter(col: Column, start: date | str, end: date | str, zone: str) -> Column:
    """``DATE(TIMESTAMP_MILLIS(col), zone)`` in ``[start, end)`` on a BIGINT millis column."""
    lo, hi = local_day_bounds_utc(start, end, zone)
    epoch = datetime(1970, 1, 1)
    lo_ms = int((lo - epoch) / timedelta(milliseconds=1))
    hi_ms = int((hi - epoch) / timedelta(milliseconds=1))
    return (col >= F.lit(lo_ms)) & (col < F.lit(hi_ms))


def local_date_of(col: Column, zone: str) -> Column:
    """Local calendar date of a UTC wall-clock timestamp (for output columns,
    not for predicates)."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), col.cast("timestamp_ntz")))
