"""Joins used by the curation jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.filters import eligible_subscriber
from tidewater.operators.replace import delete_by_key


def eligible_users(users: DataFrame) -> DataFrame:
    """The subscriber side of the tracking join: eligible rows only, with
    the three columns the join needs (column pruning reaches the scan)."""
    return users.filter(eligible_subscriber()).select(
        "user_id", "last_subscription_id", "last_subscription_plan"
    )


def join_events_subscribers(events: DataFrame, users: DataFrame, key: str = "user_id") -> DataFrame:
    """INNER equi-join on ``user_id``. Users are not deduplicated: a user
    listed twice fans its events out twice, as the source query does.

    No broadcast hint: the planner broadcasts the user side only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE
    re-checks with runtime sizes), otherwise it shuffles both sides and AQE's
    skew-join splits a hot user's partition.
    """
    return events.join(eligible_users(users), key, "inner")


def semi_delete_by_key(target: DataFrame, raw: DataFrame, key: str) -> DataFrame:
    """``DELETE FROM target WHERE key IN (SELECT key FROM raw WHERE key IS NOT
    NULL)`` as a left anti join on distinct keys."""
    return delete_by_key(target, raw, key)
