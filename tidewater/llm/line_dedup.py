"""Line dedup over levelled sorted runs of line hashes (operator 7).

A run is a Parquet table of ``(hash, n)`` rows: a 128-bit line hash and the
number of documents that hold the line, hash-partitioned and sorted by hash.
The line hashes of a table are landed once, dealt to batches by a hash of the
document, whatever its files. Each batch is counted by line hash, anti-joined with the run of
hashes that are already known to be frequent (their count can't change any
decision) and adds what is left as a new run on level 0. When a level has
``fanout`` runs they are compacted: merged, summed and written as one run of
the next level, with the hashes that reached the threshold moved to the
frequent run. At the end all levels are compacted into one.

Everything runs as DataFrame functions in the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import ascii_lower, land

# Fixed: the white space stripped from a line's ends.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_hash(line: Column) -> Column:
    """128-bit hash of a line's key; null for a key shorter than one code point."""
    key = line_key(line)
    return F.when(key != "", F.unhex(F.md5(key)))


def text_lines(text: Column) -> Column:
    """A null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _distinct_hashes(text_col: str) -> Column:
    return F.explode(F.array_distinct(F.transform(text_lines(F.col(text_col)), line_hash))).alias("hash")


class LineRuns:
    """The levelled runs; ``levels[i]`` lists the runs of level ``i``."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 3):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.frequent: DataFrame | None = None

    def add_batch(self, docs: DataFrame, text_col: str = "text") -> None:
        self.add_hashes(docs.select(_distinct_hashes(text_col)).where("hash is not null"))

    def add_hashes(self, hashes: DataFrame) -> None:
        """A batch of ``hash`` rows, one for each document and line in it."""
        counts = hashes.groupBy("hash").agg(F.count("*").alias("n"))
        if self.frequent is not None:
            counts = counts.join(self.frequent.select("hash"), "hash", "left_anti")
        self._put(0, land(counts.sortWithinPartitions("hash"), "line-run-0"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._compact(runs, f"line-run-{level + 1}"))

    def _compact(self, runs: list[DataFrame], name: str) -> DataFrame:
        merged = land(
            reduce(DataFrame.unionByName, runs)
            .groupBy("hash")
            .agg(F.sum("n").alias("n"))
            .sortWithinPartitions("hash"),
            name,
        )
        found = merged.where(F.col("n") >= self.min_docs).select("hash")
        both = found if self.frequent is None else found.union(self.frequent)
        self.frequent = land(both.distinct().sortWithinPartitions("hash"), "line-run-frequent")
        return merged.where(F.col("n") < self.min_docs)

    def finish(self) -> DataFrame:
        """Compact what is left; returns the hashes of frequent lines."""
        left = [run for level in self.levels for run in level]
        self.levels = []
        if left:
            self._put_last(left)
        if self.frequent is None:
            return self.spark.createDataFrame([], "hash binary")
        return self.frequent

    def _put_last(self, left: list[DataFrame]) -> None:
        self.levels = [[self._compact(left, "line-run-last")]]


def split_batches(rows: DataFrame, batches: int) -> list[DataFrame]:
    """``rows`` dealt to ``batches`` parts by a hash of their ``batch`` key, or
    of all their columns where they have none."""
    key = ["batch"] if "batch" in rows.columns else rows.columns
    return [rows.where(F.pmod(F.xxhash64(*key), F.lit(max(batches, 1))) == i) for i in range(max(batches, 1))]


def drop_frequent_lines(
    docs: DataFrame,
    min_docs: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    batches: list[DataFrame] | int = 4,
    fanout: int = 3,
) -> DataFrame:
    """``docs`` with the lines dropped whose key is found in at least
    ``min_docs`` documents, in every document; all columns stay, and
    ``n_lines`` (before dropping) and ``n_dropped`` are added.

    A row is a document; a key counts once for each row that holds it, so
    repeated rows count one by one. Lines are split at ``\\n``; null and
    empty texts are one empty line and become the empty text. Lines with an
    empty key are always kept. A document that loses all its lines has the
    empty text. An empty table gives no rows. Columns that are named n_lines
    or n_dropped are replaced. Very long texts are split as a whole, in memory.

    ``batches`` is a number, by which documents are dealt by a hash of id and
    text, or the batches themselves.
    """
    runs = LineRuns(docs.sparkSession, min_docs, fanout)
    # Lists go by id and text: rows without an id, or that share one, don't
    # share a list, and rows that do have the same lines.
    code = F.xxhash64(F.col(text_col))
    held = land(
        docs.select(F.col(id_col).alias("__id"), code.alias("__code"), _distinct_hashes(text_col)).where("hash is not null"),
        "line-held",
    )
    if isinstance(batches, int):
        dealt = held.select("hash", F.xxhash64("__id", "__code").alias("batch"))
        for batch in split_batches(dealt, batches):
            runs.add_hashes(batch)
    else:
        for batch in batches:
            runs.add_batch(batch, text_col)
    frequent = runs.finish()

    # (document, frequent hash) pairs, then one short list per document.
    lists = land(
        held.join(frequent, "hash", "left_semi").groupBy("__id", "__code").agg(F.collect_set("hash").alias("__drop")),
        "line-drop-lists",
    )
    lines = text_lines(F.col(text_col))
    kept = F.when(
        F.col("__drop").isNull(), lines
    ).otherwise(
        F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col("__drop"), line_hash(x)), F.lit(False)))
    )
    # The lists grow with the documents, so they are merged at every size.
    same = F.col(id_col).eqNullSafe(F.col("__id")) & code.eqNullSafe(F.col("__code"))
    out = docs.drop("n_lines", "n_dropped").join(lists.hint("merge"), same, "left")
    out = out.withColumn("__lines", F.size(lines)).withColumn("__kept", kept)
    return out.select(
        *[
            F.array_join("__kept", "\n").alias(text_col) if c == text_col else F.col(c)
            for c in docs.columns
            if c not in ("n_lines", "n_dropped")
        ],
        F.col("__lines").cast("long").alias("n_lines"),
        (F.col("__lines") - F.size("__kept")).cast("long").alias("n_dropped"),
    )
