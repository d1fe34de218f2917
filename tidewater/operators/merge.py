"""The MERGE family as DataFrame functions returning the resulting table state.

``target.k = source.k`` never matches a NULL key. Rows with a NULL in any key
can therefore never take part in the join, so they are split off *before*
the shuffle and unioned back: a third of all rows sharing a NULL key would
otherwise land in one join task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.keys import key_list, maybe_in

MATCHED = "matched"
NOT_MATCHED = "not_matched"
NOT_MATCHED_BY_SOURCE = "not_matched_by_source"

_S = "__src_"
_T_MARK = "__in_target"
_S_MARK = "__in_source"


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    null_key = _any_null(keys)
    return df.filter(~null_key), df.filter(null_key)


def _joined(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of non-NULL-key rows, source columns prefixed."""
    src = source.select(*[F.col(c).alias(_S + c) for c in source.columns]).withColumn(_S_MARK, F.lit(True))
    tgt = target.withColumn(_T_MARK, F.lit(True))
    cond = reduce(lambda a, b: a & b, [tgt[k] == src[_S + k] for k in keys])
    return tgt.join(src, cond, "full_outer")


def merge_match(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Classify every key of target and source: ``matched`` (update),
    ``not_matched`` (insert), ``not_matched_by_source`` (target only).

    Returns the keys (source value for inserts) and ``action``; NULL-key
    source rows are inserts and NULL-key target rows are target-only.
    """
    t_ok, t_null = _split_null_keys(target.select(*keys), keys)
    s_ok, s_null = _split_null_keys(source.select(*keys), keys)
    j = _joined(t_ok, s_ok, keys)
    action = (
        F.when(F.col(_T_MARK) & F.col(_S_MARK), F.lit(MATCHED))
        .when(F.col(_S_MARK), F.lit(NOT_MATCHED))
        .otherwise(F.lit(NOT_MATCHED_BY_SOURCE))
    )
    matched = j.select(*[F.coalesce(F.col(k), F.col(_S + k)).alias(k) for k in keys], action.alias("action"))
    return (
        matched.unionByName(s_null.withColumn("action", F.lit(NOT_MATCHED)))
        .unionByName(t_null.withColumn("action", F.lit(NOT_MATCHED_BY_SOURCE)))
    )


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    delete_not_matched_by_source: bool = False,
    with_action: bool = False,
) -> DataFrame:
    """``MERGE target USING source ON keys``: matched rows take every non-key
    column from the source, unmatched source rows are inserted, target-only
    rows are kept, or deleted with ``delete_not_matched_by_source``.

    The source must already hold at most one row per key (see
    ``dedupe_latest``) and carry every target column.
    """
    if not keys:
        raise ValueError("merge keys must not be empty")
    columns = target.columns
    missing = [c for c in columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}; reconcile the schema first")
    source = source.select(*columns)
    t_ok, t_null = _split_null_keys(target, keys)
    s_ok, s_null = _split_null_keys(source, keys)
    j = _joined(t_ok, s_ok, keys)
    if delete_not_matched_by_source:
        j = j.filter(F.col(_S_MARK).isNotNull())
    action = (
        F.when(F.col(_T_MARK) & F.col(_S_MARK), F.lit(MATCHED))
        .when(F.col(_S_MARK), F.lit(NOT_MATCHED))
        .otherwise(F.lit(NOT_MATCHED_BY_SOURCE))
    )
    out = [
        F.when(F.col(_S_MARK).isNotNull(), F.col(_S + c)).otherwise(F.col(c)).alias(c) for c in columns
    ]
    if with_action:
        out.append(action.alias("action"))
    merged = j.select(*out)
    inserts = s_null.withColumn("action", F.lit(NOT_MATCHED)) if with_action else s_null
    result = merged.unionByName(inserts)
    if not delete_not_matched_by_source:
        kept = t_null.withColumn("action", F.lit(NOT_MATCHED_BY_SOURCE)) if with_action else t_null
        result = result.unionByName(kept)
    return result


def merge_counts(classified: DataFrame) -> DataFrame:
    """Rows per action (the DML 'affected rows' report)."""
    return classified.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def anti_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], bloom_bits: int | None = None) -> DataFrame:
    """Insert-only MERGE: source rows whose key is absent from the target are
    appended; the source is *not* deduplicated (two equal new keys both land).

    The anti join needs only the target's keys (see ``key_list``), and with
    ``bloom_bits`` (see :func:`keys.maybe_in`) only those that the source may
    hold, so what is shuffled follows the batch.
    """
    src = source.select(*target.columns) if set(target.columns) <= set(source.columns) else source
    held = target if bloom_bits is None else target.filter(maybe_in(target, keys, source, bloom_bits))
    tgt_keys = key_list(held, keys)
    src_ok, src_null = _split_null_keys(src, keys)
    # A NULL key never matches, so those rows are inserted without a join.
    new_rows = src_ok.join(tgt_keys, list(keys), "left_anti").unionByName(src_null)
    return target.unionByName(new_rows, allowMissingColumns=True)
