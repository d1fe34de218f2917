"""Row filters. Each returns a filtered DataFrame; predicates are built from
plain columns so Catalyst pushes them into the Parquet scan."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import contract as C
from tidewater.functions import time as TM


def _dtype(df: DataFrame, col: str):
    return df.schema[col].dataType


def filter_local_day(
    df: DataFrame, ts_col: str, start: date | str, end: date | str, zone: str
) -> DataFrame:
    """``DATE(ts, zone) >= start AND < end`` as a UTC range on the raw column."""
    return df.filter(TM.local_date_filter(F.col(ts_col), start, end, zone, _dtype(df, ts_col)))


def filter_local_week(
    df: DataFrame, epoch_col: str, start: date | str, end: date | str, zone: str
) -> DataFrame:
    """Local dates ``[start, end)`` of an integer epoch column in either unit;
    NULL epochs drop out."""
    lo, hi = TM.local_day_bounds_utc(start, end, zone)
    return df.filter(TM.epoch_auto_unit_range(F.col(epoch_col), lo, hi))


def filter_event_name_set(df: DataFrame, contract: C.EventContract = C.TRACKING_CONTRACT) -> DataFrame:
    return df.filter(C.name_in_set(contract))


def filter_exactly_one_flag(df: DataFrame, contract: C.EventContract = C.TRACKING_CONTRACT) -> DataFrame:
    return df.filter(C.exactly_one_flag(contract))


def filter_event_contract(df: DataFrame, contract: C.EventContract = C.TRACKING_CONTRACT) -> DataFrame:
    """Name in set, exactly one flag, and the per-name attribute contract."""
    return df.filter(C.full_contract(contract))


def eligible_subscriber(
    id_col: str = "last_subscription_id", plan_col: str = "last_subscription_plan", excluded: str = "%BEGINNER%"
) -> Column:
    """Subscription id present and non-empty; plan ``NOT LIKE`` the excluded
    pattern (a NULL plan is excluded, as in SQL)."""
    sub = F.col(id_col)
    return sub.isNotNull() & (sub != F.lit("")) & ~F.col(plan_col).like(excluded)


def filter_eligible_subscribers(df: DataFrame, **kwargs) -> DataFrame:
    return df.filter(eligible_subscriber(**kwargs))


def filter_late_rows(
    staged: DataFrame,
    staged_col: str,
    final: DataFrame | None,
    final_col: str,
    policy: str = "drop",
) -> DataFrame:
    """Keep staged rows strictly newer than ``COALESCE(MAX(final.col), epoch)``.

    Ties at the watermark and NULL increments drop. The watermark is a scalar
    subquery: computed once, broadcast to every task as a constant, and also
    handed to the Parquet reader as a runtime filter.
    ``policy="accept"`` disables the filter (backfills of older rows).
    """
    if policy == "accept":
        return staged
    epoch = F.lit(TM.EPOCH_NTZ).cast(_dtype(staged, staged_col))
    if final is None:
        return staged.filter(F.col(staged_col) > epoch)
    wm = final.agg(F.max(final_col).alias("__wm")).scalar()
    return staged.filter(F.col(staged_col) > F.coalesce(wm, epoch))


def filter_above(staged: DataFrame, staged_col: str, watermark: Column | None) -> DataFrame:
    """The same rule for a watermark that is known already (None: no rows yet)."""
    epoch = F.lit(TM.EPOCH_NTZ).cast(_dtype(staged, staged_col))
    return staged.filter(F.col(staged_col) > (epoch if watermark is None else watermark))


def non_blank(cols: list[str]) -> Column:
    """Any cell non-empty (NULL and ``''`` both count as empty)."""
    return reduce(
        lambda a, b: a | b,
        [F.length(F.coalesce(F.col(c).cast("string"), F.lit(""))) > 0 for c in cols],
    )


def filter_blank_rows(df: DataFrame) -> DataFrame:
    return df.filter(non_blank(df.columns))


def filter_key_not_null(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def filter_incremental_window(
    df: DataFrame, inc_col: str, start: datetime | None, end: datetime | None
) -> DataFrame:
    """Replication window ``inc > start AND inc <= end``; either bound optional."""
    return df.filter(TM.instant_range(F.col(inc_col), start, end, _dtype(df, inc_col), closed="right"))
