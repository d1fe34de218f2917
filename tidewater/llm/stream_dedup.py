"""Exact dedup by a stateful stream (operator 9).

Documents arrive as a stream of ``(digest, doc_id, locator)`` rows. A keyed
state without expiry, kept on disk by the RocksDB state store and
checkpointed to the shared folder, retains for each content digest the
stable identifier of the row that stays, the locator of its content and the
number of rows seen. After the stream, every group with more than one row (a
hit) is checked on its full bytes.

Everything runs as DataFrame and Structured Streaming operations in the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, land, partitions
from tidewater.session import scratch_path

# State on disk; each micro-batch uploads its changes instead of whole files,
# and the many small stores preallocate no disk.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, n_bytes, locator)`` per row; null text is empty."""
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(norm, 256)).alias("digest"),
        F.octet_length(norm).cast("long").alias("n_bytes"),
        F.input_file_name().alias("locator"),
    )


def run_state_stream(feed_path: str, schema, spark, files_per_batch: int, root: str) -> DataFrame:
    """Stream the landed fingerprints through the keyed state.

    Each micro-batch appends the groups that it changed to ``root/updates``
    under its epoch, overwriting a folder that a failed attempt left; the
    stream restarts from ``root/checkpoint``. Returns the last state of each
    digest: keep_id, locator, group_size.
    """
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(feed_path)
    state = feed.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("keeper"),
        F.count("*").alias("group_size"),
    )

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/updates/epoch={epoch}")

    before = {name: spark.conf.get(name, None) for name in STATE_SETTINGS}
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(save)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
    updates = spark.read.schema(
        "digest binary, keeper struct<doc_id:bigint,locator:string>, group_size bigint, epoch int"
    ).parquet(f"{root}/updates")
    # Both grow with the epochs, so the maxima are the last state.
    last = updates.groupBy("digest").agg(F.max("keeper").alias("keeper"), F.max("group_size").alias("group_size"))
    return last.select("digest", F.col("keeper.doc_id").alias("keep_id"), F.col("keeper.locator").alias("locator"), "group_size")


def dedup_stream(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = 3
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256, locator (of the content that stays).

    Texts are equal when identical after lower-casing A-Z; of equal texts the
    row with the largest id stays. Null text counts as empty, null ids sort
    below every other id. Rows that repeat an id and its text count towards
    ``group_size`` one by one, and all rows that carry the largest id are
    kept. An empty table gives no rows. Other columns are ignored.

    ``batches`` is the number of micro-batches the landed feed is dealt into.
    """
    spark = docs.sparkSession
    root = scratch_path(spark, "stream-dedup")
    files = partitions(spark)
    keyed = fingerprints(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    keyed.write.parquet(f"{root}/feed")
    feed = spark.read.schema(keyed.schema).parquet(f"{root}/feed")
    files = max(1, len(feed.inputFiles()))
    last = land(run_state_stream(f"{root}/feed", keyed.schema, spark, -(-files // batches), root), "stream-dedup-state")
    wrong = differing(docs, id_col, text_col, last)
    if not wrong.isEmpty():
        return regrouped(docs, id_col, text_col)
    return feed.join(last.withColumnRenamed("locator", "keeper_locator"), "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("keeper_locator").alias("locator"),
    )


def differing(docs: DataFrame, id_col: str, text_col: str, last: DataFrame) -> DataFrame:
    """Digests under which not all full texts are the same bytes.

    Only hits are read: the rows of groups with more than one row. Their
    smallest and largest text are combined before the shuffle, so a group
    with a third of all rows sends one pair of texts per task.
    """
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    hits = last.where("group_size > 1").select("digest")
    rows = docs.select(F.unhex(F.sha2(norm, 256)).alias("digest"), norm.alias("norm")).join(hits, "digest", "left_semi")
    return rows.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi")).where("lo <> hi")


def regrouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Groups by whole text, for the case that a digest covers two texts."""
    norm = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"), F.input_file_name().alias("file"))
    groups = land(
        rows.groupBy("norm").agg(F.max(F.struct("doc_id", "file")).alias("keeper"), F.count("*").alias("group_size")),
        "stream-dedup-regrouped",
    )
    return rows.join(groups, "norm").select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")).alias("kept"),
        F.sha2("norm", 256).alias("text_sha256"),
        F.col("keeper.file").alias("locator"),
    )
