"""Schema evolution as projections: a table's new shape is one ``select``."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)


def evolve_schema_additive(df: DataFrame, desired: T.StructType) -> DataFrame:
    """Add desired columns the table lacks (typed NULL, appended at the end);
    existing columns keep their position and type."""
    have = set(df.columns)
    extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in desired.fields if f.name not in have]
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *extra)


_INTEGRAL_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


def can_widen(src: T.DataType, dst: T.DataType) -> bool:
    """Type changes a warehouse table accepts in place: integer widening,
    integer/float to double, decimal widening, anything to string."""
    if src == dst or isinstance(dst, T.StringType):
        return True
    if type(src) in _INTEGRAL_RANK and type(dst) in _INTEGRAL_RANK:
        return _INTEGRAL_RANK[type(src)] <= _INTEGRAL_RANK[type(dst)]
    if isinstance(dst, T.DoubleType) and (type(src) in _INTEGRAL_RANK or isinstance(src, T.FloatType)):
        return True
    if isinstance(src, T.DecimalType) and isinstance(dst, T.DecimalType):
        return dst.scale >= src.scale and (dst.precision - dst.scale) >= (src.precision - src.scale)
    if type(src) in _INTEGRAL_RANK and isinstance(dst, T.DecimalType):
        return dst.precision - dst.scale >= 19
    if isinstance(src, T.TimestampNTZType) and isinstance(dst, T.TimestampNTZType):
        return True
    return False


def reconcile_schema(df: DataFrame, desired: T.StructType) -> DataFrame:
    """Bring a table to ``desired``: add missing columns, drop columns not in
    ``desired``, change types. A type change the table cannot take in place
    is logged and skipped (the column keeps its current type)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in desired.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            out.append(F.col(f"`{f.name}`"))
        elif can_widen(have[f.name], f.dataType):
            out.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            log.warning("skipping type change of %s from %s to %s", f.name, have[f.name], f.dataType)
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name: casts present columns, fills
    absent ones with typed NULL, ignores unknown ones."""
    return df.select(
        *[
            (F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )
