"""Structured Streaming forms of the scheduled micro-batch flows.

* ``merge_stream``: a file source feeds ``foreachBatch``; each micro-batch
  is merged into the final table, which is partitioned by a hash of its keys,
  so only the partitions that the batch touches are rewritten. The stream's
  checkpoint is the bookmark: a restarted run resumes after the last committed
  batch, and a batch that failed half way is replayed with its own id.
* ``latest_stream``: keep-latest as keyed state of the stream. Files may arrive
  in any order: the state, not the table, knows the newest row of a key.
* ``dedupe_stream``: ``dropDuplicatesWithinWatermark`` on the event key.
  The delay must cover the real disorder of the input, or late duplicates
  pass and late first copies are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators import filters
from tidewater.session import scratch_path
from tidewater.sinks import files, keyed


def merge_stream(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    table: keyed.KeyedTable,
    prepare: Callable[[DataFrame, Column | None], DataFrame],
    checkpoint: str | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """Merge all available input into ``table`` and return its rows.
    ``prepare(batch, watermark)`` gives a batch's rows, at most one per key;
    the watermark is read from the table's footers (None without an order
    column, or rows). It is written down before the merge, so the replay of a
    batch that was merged in part drops the same late rows as its first run."""
    checkpoint = checkpoint or scratch_path(spark, "merge-stream-ckpt")
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        mark = None
        if table.order_col:
            mark = noted_watermark(spark, table, checkpoint, str(epoch_id))
        keyed.merge_batch(table, prepare(batch, mark), f"{stream_id}-{epoch_id}")

    stream = (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(source_path)
    )
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return keyed.read(spark, table)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def latest_stream(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    table: keyed.KeyedTable,
    project: Callable[[DataFrame], DataFrame],
    order_by: list[str],
    late_policy: str = "drop",
    checkpoint: str | None = None,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1,
) -> DataFrame:
    """Merge all available input into ``table``, the newest row of each key by
    ``order_by`` (then by the other columns, both descending), and return the
    table's rows.

    The newest row per key is a streaming maximum over (order, row): native
    keyed state on disk, without expiry, that survives restarts. A row that is
    older than its key's state changes nothing, whenever it arrives; the late-row
    rule (``late_policy="drop"``) compares with the table's watermark when the
    stream first began. So the outcome is that of one batch
    merge over all files, in any order and over any restarts. Each trigger
    upserts the keys it has seen, so its replay is harmless; rows without a key
    are one group, as in the batch form, and replace each other.
    """
    checkpoint = checkpoint or scratch_path(spark, "latest-stream-ckpt")
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    columns = table.schema.fieldNames()
    order = [*order_by, *(c for c in columns if c not in order_by and c not in table.keys)]

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        keyed.merge_batch(table, batch.select(*columns), stream_id)

    rows = project(
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).load(source_path)
    )
    if late_policy == "drop" and table.order_col:
        rows = filters.filter_above(rows, table.order_col, noted_watermark(spark, table, checkpoint))
    newest = rows.groupBy(*table.keys).agg(F.max(F.struct(*order)).alias("__row")).select(*table.keys, "__row.*")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, ROCKSDB)
    try:
        query = (
            newest.writeStream.foreachBatch(on_batch)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return keyed.read(spark, table)


def noted_watermark(spark: SparkSession, table: keyed.KeyedTable, checkpoint: str, name: str = "first") -> Column | None:
    """The table's watermark when it was first asked for under this name; it is
    written down beside the checkpoint, so a replay or restart sees the same."""
    note = f"{checkpoint.rstrip('/')}-watermarks/{name}"
    known = files.read_text_file(spark, note)
    if known is None:
        micros, _ = keyed.footer_max(spark, table.path, keyed.ORDER, keyed._stored(table))
        known = "" if micros is None else str(micros)
        files.write_text_file(spark, note, known)
    return keyed.order_literal(table, int(known)) if known else None


def dedupe_stream(
    stream: DataFrame,
    key: str,
    event_time: str,
    delay: str,
    out: str,
    checkpoint: str,
) -> DataFrame:
    """First row per key within the watermark delay, written as Parquet files
    to ``out`` (a folder of the shared store) and read back once drained.
    ``withWatermark`` needs a TIMESTAMP column, so NTZ event times are
    cast first."""
    timed = stream.withColumn("__event_time", F.col(event_time).cast("timestamp"))
    deduped = timed.withWatermark("__event_time", delay).dropDuplicatesWithinWatermark([key]).drop("__event_time")
    query = (
        deduped.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(deduped.schema).parquet(out)
