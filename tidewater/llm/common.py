"""Helpers that the training-data operators share.

Intermediate tables go to a new folder under the shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local one, so a lost executor
costs only the tasks it was running. Reading a landed table back also puts a
plain scan below the next join, which lets AQE split a hot key there.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import configure_session, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure_session(spark)
    one_thread(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def one_thread(spark: SparkSession) -> None:
    """Python workers compute on one thread each; Spark runs one per core."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        spark.sparkContext.environment.setdefault(name, "1")


def land(df: DataFrame, name: str, level: int = 3) -> DataFrame:
    """Write ``df`` as Parquet, compressed at ``level``, to the shared folder
    and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other code point stays as it is."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)``.

    Returns ``(node, component)`` with the smallest node as component, for
    every node of an edge. Alternating large-star and small-star steps on the
    edge list: each is one grouped minimum (combined before the shuffle) and
    one join, and each result is landed, so no step collects a neighbourhood
    or a component, in a task or on the driver. Self loops and repeated edges
    are harmless; an empty list gives an empty result.
    """
    cur = land(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-edges"
    )
    while True:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Both minima are landed, so AQE can split a node with very many edges.
        least = land(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{name}-least")
        # Large star: hang every larger neighbour on the smallest one.
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.where("m < u").select("u", F.col("m").alias("v")))
        )
        low = land(large.groupBy("u").agg(F.min("v").alias("m")), f"{name}-low")
        # Small star: hang the node and its smaller neighbours on the smallest.
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .where("u > v")
            .distinct()
        )
        nxt = land(small, f"{name}-small")
        # Stars are reached when every node hangs on one root that hangs on none.
        state = nxt.agg(F.count("*").alias("n"), F.count_distinct("u").alias("d")).first()
        hanging = nxt.join(nxt.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        cur = nxt
        if state["n"] == state["d"] and hanging == 0:
            break
    roots = cur.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
