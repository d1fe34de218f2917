"""The corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

Every stage takes a row as a document, whether its id is repeated or null, and
gives no rows for an empty table. Texts are read whole, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import line_dedup, mixing, near_dup, packing, quality
from tidewater.llm.common import land, table

ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null text is scored as the
    empty text; without usable labels of both kinds all documents stay. Other
    columns are not looked at."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in many documents go, the documents stay, those that lose
    all their lines with the empty text. Null text becomes the empty text.
    Columns named n_lines or n_dropped get the counts of the stage."""
    return line_dedup.drop_frequent_lines(docs).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, or the
    first of those without ids. Documents without words all stay."""
    return near_dup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities stay. A missing
    source or language is a value of its own; null and empty texts weigh
    nothing and have the probability of their cell. Rows that repeat an id are
    drawn alike, rows without one each by itself."""
    return mixing.sample_mixture(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences. Null and empty texts are
    one piece of the closing id alone; only doc_id and text are looked at."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", dedup_lines),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
