"""Keep-latest deduplication: ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY
...) = 1``.

Catalyst rewrites ``row_number() ... = 1`` into a partial ``WindowGroupLimit``
that runs *before* the shuffle: every map task keeps only its best row per
key, so a key holding a third of all rows ships one row per map task, not a
third of the table. The window's hash partitioning on the keys is then reused
by a following join on the same keys (the merge), with no second exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OrderSpec = Sequence[tuple[str, str] | str]

_UNORDERABLE = (T.MapType, T.VariantType)


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, _UNORDERABLE):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def order_columns(df: DataFrame, order_by: OrderSpec, partition_by: Sequence[str], tie_break: bool = True) -> list[Column]:
    """Sort expressions for ``order_by`` (default DESC, NULLS LAST as in the
    warehouse). With ``tie_break`` every remaining orderable column is
    appended DESC so ties resolve the same way on every run."""
    cols: list[Column] = []
    used = set(partition_by)
    for item in order_by:
        name, direction = (item, "desc") if isinstance(item, str) else item
        c = F.col(name)
        cols.append(c.asc_nulls_first() if direction.lower() == "asc" else c.desc_nulls_last())
        used.add(name)
    if tie_break:
        for f in df.schema.fields:
            if f.name not in used and _orderable(f.dataType):
                cols.append(F.col(f.name).desc_nulls_last())
    return cols


def dedupe_latest(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: OrderSpec,
    tie_break: bool = True,
) -> DataFrame:
    """One row per key: the first in ``order_by`` order. NULL keys form one
    group, as in SQL ``PARTITION BY``."""
    if not partition_by:
        raise ValueError("partition_by must not be empty")
    if not order_by:
        raise ValueError("order_by must not be empty")
    w = Window.partitionBy(*partition_by).orderBy(*order_columns(df, order_by, partition_by, tie_break))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
