"""Replacement operators: delete a slice of the target, insert the rebuilt
slice. Each returns the whole resulting table state; the sink writes it as
one snapshot (or replaces only the touched partitions)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions import time as TM
from tidewater.operators.dedupe import OrderSpec, dedupe_latest
from tidewater.operators.keys import key_list, maybe_in


def delete_by_key(target: DataFrame, keys_from: DataFrame, key: str, bloom_bits: int | None = None) -> DataFrame:
    """``DELETE FROM target WHERE key IN (SELECT key FROM keys_from WHERE key
    IS NOT NULL)``. A NULL target key survives. A hot key is collapsed in the
    key list and split among tasks in the target (see ``key_list``).

    ``bloom_bits`` (see :func:`keys.maybe_in`): target rows that can't match
    skip the join, so what is shuffled follows the batch. It reads ``keys_from``
    once more, so give it a stored table."""
    keys = key_list(keys_from, [key])
    if bloom_bits is not None:
        maybe = maybe_in(target, [key], keys_from, bloom_bits)
        return target.filter(maybe).join(keys, key, "left_anti").select(*target.columns).unionByName(target.filter(~maybe))
    # NULL-key rows always survive; they skip the join instead of all hashing
    # to one join partition.
    kept = target.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")
    return kept.unionByName(target.filter(F.col(key).isNull()))


def replace_by_key(
    target: DataFrame, raw: DataFrame, key: str, order_by: OrderSpec, bloom_bits: int | None = None
) -> DataFrame:
    """Delete every target row whose key occurs in ``raw``, then insert the
    latest raw row per non-NULL key."""
    kept = delete_by_key(target, raw, key, bloom_bits)
    latest = dedupe_latest(raw.filter(F.col(key).isNotNull()), [key], order_by)
    return kept.unionByName(latest.select(*target.columns))


def replace_local_day(
    target: DataFrame,
    rebuilt: DataFrame,
    millis_col: str,
    start: date | str,
    end: date | str,
    zone: str,
) -> DataFrame:
    """Drop target rows whose ``DATE(TIMESTAMP_MILLIS(col), zone)`` is in
    ``[start, end)`` and add the rebuilt rows. An empty rebuild still deletes."""
    in_window = TM.millis_local_date_filter(F.col(millis_col), start, end, zone)
    kept = target.filter(~in_window | F.col(millis_col).isNull())
    return kept.unionByName(rebuilt.select(*target.columns))


def replace_date_range(
    target: DataFrame, new_rows: DataFrame, date_col: str, start: date | str, end: date | str
) -> DataFrame:
    """``DELETE WHERE DATE(col) BETWEEN start AND end`` (inclusive) then append.
    Rows with a NULL date survive the delete; the delete runs even when
    ``new_rows`` is empty."""
    start_d = date.fromisoformat(start) if isinstance(start, str) else start
    end_d = date.fromisoformat(end) if isinstance(end, str) else end
    dtype = target.schema[date_col].dataType
    col = F.col(date_col)
    if isinstance(dtype, T.DateType):
        in_range = col.between(F.lit(start_d), F.lit(end_d))
    elif isinstance(dtype, T.StringType):
        in_range = F.try_to_date(col).between(F.lit(start_d), F.lit(end_d))
    else:
        in_range = (col >= TM.ts_literal(str(start_d), dtype)) & (
            col < TM.ts_literal(str(end_d + timedelta(days=1)), dtype)
        )
    # Only rows whose date is known to be in range are deleted: NULL (and,
    # for text dates, unparsable) dates survive.
    kept = target.filter(~F.coalesce(in_range, F.lit(False)))
    return kept.unionByName(new_rows, allowMissingColumns=True)


def truncate_load(new_rows: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The new contents of a truncated table, cast to its declared schema
    (an empty input still carries the schema)."""
    if schema is None:
        return new_rows
    return new_rows.select(
        *[
            (F.col(f.name) if f.name in new_rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def append_evolving(target: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Append allowing new columns: old rows read NULL for them."""
    return target.unionByName(new_rows, allowMissingColumns=True)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
