"""Mixing sources to target weights by iterative proportional fitting
(operator 1).

Token weights are summed by cell (source, language, topic). Raking scales
the cells to each marginal in turn until all marginals hold, never beyond
the tokens that a cell has. A cell's weight over its tokens is the
probability with which each of its documents is sampled.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import land

DIMS = ("source", "lang", "topic")
NONE = "(none)"
BUDGET = 0.5  # share of all tokens that is sampled
TOLERANCE, SWEEPS = 1e-3, 30
# Shares per language; natural shares to these powers for the other margins,
# and for all languages (and none) that are not listed.
LANGUAGES = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}
POWERS = {"source": 0.5, "lang": 0.5, "topic": 0.7}


class Named(NamedTuple):
    """A target of given shares for some values: every other value found gets
    its natural share to a power, and the given ones share what is left."""

    shares: Mapping[str, float]
    power: float


Target = Mapping[str, float] | Named | float


def token_count(text: Column) -> Column:
    """Tokens of a text, counted as words between white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def topic_of(text: Column) -> Column:
    """A topic where the table has none: the form that a text is written in."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(t.contains(" | "), "table")
        .when(t.rlike(r"[=<>{}]"), "markup")
        .when(t.rlike(r"[0-9]"), "figures")
        .when(F.length(t) < 600, "note")
        .otherwise("prose")
    )


def weighted(docs: DataFrame, topic: Column | None = None) -> DataFrame:
    """``docs`` with __source, __lang, __topic (null: ``(none)``) and __n."""
    text = F.col("text").cast("string")
    return docs.select(
        "*",
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("__source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("__lang"),
        F.coalesce((topic_of(text) if topic is None else topic).cast("string"), F.lit(NONE)).alias("__topic"),
        token_count(text).alias("__n"),
    )


def margin(cells: DataFrame, dim: str, target: Target) -> DataFrame:
    """``(dim, share)`` of a margin over the values that have tokens: given
    shares (values without one get none), natural shares to a power, or both."""
    sums = cells.groupBy(dim).agg(F.sum("n").cast("double").alias("s"))
    if isinstance(target, Named):
        given = F.lit(None).cast("double")
        for value, share in target.shares.items():
            given = F.when(F.col(dim) == value, F.lit(float(share))).otherwise(given)
        sums = sums.select(dim, given.alias("given"), F.pow("s", F.lit(float(target.power))).alias("natural"))
        named = F.col("given").isNotNull()
        both = sums.where(named).agg(F.sum("given").alias("all_given"), F.sum("natural").alias("all_natural"))
        sums = sums.join(F.broadcast(both))
        raw = F.when(named, F.try_divide(F.col("given"), F.col("all_given")) * F.col("all_natural")).otherwise(F.col("natural"))
    elif isinstance(target, Mapping):
        raw = F.lit(0.0)
        for value, share in target.items():
            raw = F.when(F.col(dim) == value, F.lit(float(share))).otherwise(raw)
    else:
        raw = F.pow("s", F.lit(float(target)))
    raw = sums.select(dim, raw.alias("raw")).where("raw > 0")
    total = raw.agg(F.sum("raw").alias("total"))
    return land(raw.join(F.broadcast(total)).select(dim, (F.col("raw") / F.col("total")).alias("share")), f"mix-{dim}")


def rake(cells: DataFrame, targets: Mapping[str, Target], tokens: float) -> DataFrame:
    """Cells ``(source, lang, topic, n)`` with the weight ``w`` whose margins
    are the targets' shares of ``tokens``. ``w`` is 0 for a value without a
    share and at most ``n``; a margin that needs more than its cells hold
    keeps what they hold."""
    margins = {d: margin(cells, d, t) for d, t in targets.items()}
    state = land(cells.withColumn("w", F.col("n").cast("double")), "mix-cells")
    for _ in range(SWEEPS):
        out = state.withColumn("before", F.col("w"))
        for d, m in margins.items():
            # Sums are combined per task; the sides of these joins are margins.
            sums = out.groupBy(d).agg(F.sum("w").alias("s")).where("s > 0")
            factor = sums.join(m, d).select(d, (F.col("share") * tokens / F.col("s")).alias("f"))
            out = out.join(factor, d, "left").withColumn("w", F.least("n", F.col("w") * F.coalesce("f", F.lit(0.0)))).drop("f")
        state = land(out, "mix-sweep")
        off = state.agg(F.sum(F.abs(F.col("w") - F.col("before"))).alias("d"), F.sum("w").alias("w")).first()
        state = state.drop("before")
        if not off["w"] or off["d"] <= TOLERANCE * off["w"]:
            break
    return state


def calibrated(
    docs: DataFrame,
    budget: float = BUDGET,
    targets: Mapping[str, Target] | None = None,
    topic: Column | None = None,
    seed: int = 17,
) -> DataFrame:
    """``docs`` with topic, n_tokens, probability and selected in columns
    __topic, __n, __p and __selected.

    Documents without source, language or topic form a value ``(none)`` of
    their own, which by default has a share as any other value that is found;
    null and empty texts have no tokens, and the probability of
    their cell. A cell without tokens has probability 0. The draw follows
    from the id, so repeated rows are drawn alike; rows without an id are drawn
    each by itself, by its place in ``docs``. An empty table gives no rows.
    """
    targets = targets or {"source": POWERS["source"], "lang": Named(LANGUAGES, POWERS["lang"]), "topic": POWERS["topic"]}
    rows = weighted(docs, topic)
    cells = land(
        rows.groupBy("__source", "__lang", "__topic").agg(F.sum("__n").alias("n"))
        .select(F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"), "n")
        .where("n > 0"),
        "mix-counts",
    )
    total = cells.agg(F.sum("n")).first()[0] or 0
    raked = rake(cells, targets, budget * total).select(
        F.col("source").alias("__source"), F.col("lang").alias("__lang"), F.col("topic").alias("__topic"),
        (F.col("w") / F.col("n")).alias("__p"),
    )
    out = rows.withColumn("__place", F.monotonically_increasing_id()).join(land(raked, "mix-probabilities"), ["__source", "__lang", "__topic"], "left")
    by_id = F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed))
    by_place = F.xxhash64("__place", F.xxhash64("text"), F.lit(seed))
    of_row = F.when(F.col("doc_id").isNotNull(), by_id).otherwise(by_place)
    draw = F.pmod(of_row, F.lit(1 << 40)) / F.lit(float(1 << 40))
    p = F.coalesce("__p", F.lit(0.0))
    return out.withColumn("__p", p).withColumn("__selected", draw < F.col("__p")).drop("__place")


def mixture(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, lang, topic, n_tokens,
    probability, selected; see :func:`calibrated`."""
    need = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "text")
    return calibrated(need, **settings).select(
        "doc_id", "source", "lang", F.col("__topic").alias("topic"), F.col("__n").alias("n_tokens"),
        F.col("__p").alias("probability"), F.col("__selected").alias("selected"),
    )


def sample_mixture(docs: DataFrame, **settings) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns."""
    return calibrated(docs, **settings).where("__selected").select(docs.columns)
