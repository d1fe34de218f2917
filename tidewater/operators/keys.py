"""Key lists for semi and anti joins, and Bloom filters of keys.

A join only has to move the rows whose keys the other side may hold. A Bloom
filter of the small side's keys tells most of the others apart where they are
read; they skip the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_list(df: DataFrame, keys: Sequence[str], spread: int = 8) -> DataFrame:
    """The non-NULL keys of ``df`` for a semi or anti join, at most ``spread``
    rows per key. Keys are combined per task and spread group, which leaves
    them partitioned otherwise than the join wants: the join keeps a plain
    exchange on each side, so AQE can split a hot key of the other side."""
    salted = df.select(*keys, (F.spark_partition_id() % spread).alias("__spread")).dropna(subset=list(keys))
    return salted.groupBy(*keys, "__spread").agg(F.count(F.lit(1)).alias("__n")).select(*keys)


BLOOM_BITS = 1 << 22  # 512 KB; up to about a million keys it tells most others apart


def _positions(keys: Sequence[Column], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(bits)) for seed in (1, 2)]


def maybe_in(df: DataFrame, keys: Sequence[str], of: DataFrame, bits: int = BLOOM_BITS) -> Column:
    """Whether a row of ``df`` may have a key of ``of``: false only if it has
    none, and false where a key is NULL. Keys are compared in ``df``'s types.

    The filter is one array of ``bits`` bits (a fixed size, whatever the keys),
    built by a partial aggregate and handed to the scan of ``df`` as a scalar
    subquery. With more keys than it is made for, more rows pass; none is lost.
    """
    typed = [F.col(k).cast(df.schema[k].dataType) for k in keys]
    at = of.select(*keys).dropna().select(F.explode(F.array(*_positions(typed, bits))).alias("p"))
    words = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(p & 63))")).alias("bits")
    )
    every = df.sparkSession.range(bits // 64).withColumnRenamed("id", "w")
    filled = every.join(words, "w", "left").select("w", F.coalesce("bits", F.lit(0)).alias("bits"))
    array = filled.agg(F.array_sort(F.collect_list(F.struct("w", "bits"))).alias("a")).select(F.col("a.bits").alias("a")).scalar()
    found = F.lit(True)
    for p in _positions([F.col(k) for k in keys], bits):
        word = F.element_at(array, (F.shiftright(p, 6) + 1).cast("int"))
        found = found & (F.call_function("shiftrightunsigned", word, p.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known & F.coalesce(found, F.lit(False))
