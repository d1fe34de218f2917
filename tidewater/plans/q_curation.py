"""Queries of the daily tracking curation (filters, join, layout, day replace)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater import fixtures as fx
from tidewater import oracle as O
from tidewater.operators import filters, joins, project, replace
from tidewater.plans import jobs
from tidewater.plans.registry import register

DAY, NEXT_DAY, ZONE = "2024-01-10", "2024-01-11", "America/Chicago"
_TRACK = O.with_ctes(O.FX_TRACKING)
_TRACK_USERS = O.with_ctes(O.FX_TRACKING, O.FX_DIM_USER)
_DAY_SQL = f"{O.local_date('event_timestamp', ZONE)} >= date '{DAY}' and {O.local_date('event_timestamp', ZONE)} < date '{NEXT_DAY}'"


@register("filter_local_day", _TRACK + f"select * from fx_tracking where {_DAY_SQL}")
def q_filter_local_day(spark, sf):
    """Events of one local day in America/Chicago, as a pushed-down UTC range."""
    return filters.filter_local_day(fx.tracking_events(spark, sf), "event_timestamp", DAY, NEXT_DAY, ZONE)


@register(
    "filter_event_name_set",
    _TRACK + "select * from fx_tracking where name in ('session_created','quick_buy_sell','partials_taken',"
    "'position_managed','replay_activated','news_visibility_clicked','order_placed')",
)
def q_filter_event_name_set(spark, sf):
    return filters.filter_event_name_set(fx.tracking_events(spark, sf))


@register(
    "filter_exactly_one_flag",
    _TRACK + "select * from fx_tracking where coalesce(is_session_created,0)+coalesce(is_quick_buy_sell,0)"
    "+coalesce(is_partials_taken,0)+coalesce(is_position_managed,0)+coalesce(is_replay_activated,0)"
    "+coalesce(is_news_visibility_open,0)+coalesce(is_order_placed,0) = 1",
)
def q_filter_exactly_one_flag(spark, sf):
    return filters.filter_exactly_one_flag(fx.tracking_events(spark, sf))


@register("filter_event_contract", _TRACK + f"select * from fx_tracking where {O.CONTRACT_WHERE}")
def q_filter_event_contract(spark, sf):
    return filters.filter_event_contract(fx.tracking_events(spark, sf))


@register(
    "filter_eligible_subscribers",
    O.with_ctes(O.FX_DIM_USER) + f"select * from fx_dim_user where {O.ELIGIBLE_WHERE}",
)
def q_filter_eligible_subscribers(spark, sf):
    return filters.filter_eligible_subscribers(fx.dim_users(spark, sf))


_JOIN_SQL = _TRACK_USERS + f"""
select e.*, u.last_subscription_id, u.last_subscription_plan
 from (select * from fx_tracking where {O.CONTRACT_WHERE}) e
 join (select * from fx_dim_user where {O.ELIGIBLE_WHERE}) u on e.user_id = u.user_id"""


@register("join_events_subscribers", _JOIN_SQL)
def q_join_events_subscribers(spark, sf):
    """Contract-valid events joined to eligible subscribers (users fan out)."""
    ev = filters.filter_event_contract(fx.tracking_events(spark, sf))
    return joins.join_events_subscribers(ev, fx.dim_users(spark, sf))


_CURATED_SQL = _TRACK_USERS + O.TRACKING_SELECT + f"""
 from (select * from fx_tracking where {O.CONTRACT_WHERE}) e
 join (select * from fx_dim_user where {O.ELIGIBLE_WHERE}) u on e.user_id = u.user_id"""


@register("project_tracking_columns", _CURATED_SQL)
def q_project_tracking_columns(spark, sf):
    """All days curated into the 26-column layout."""
    return jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf))


_CURATED_DAY_SQL = _TRACK_USERS + O.TRACKING_SELECT + f"""
 from (select * from fx_tracking where {O.CONTRACT_WHERE} and {_DAY_SQL}) e
 join (select * from fx_dim_user where {O.ELIGIBLE_WHERE}) u on e.user_id = u.user_id"""


def _stale_target(spark, sf):
    """A curated table whose refresh day also holds stale rows that a
    faulty earlier run let through (events outside the name set)."""
    ev, users = fx.tracking_events(spark, sf), fx.dim_users(spark, sf)
    good = jobs.curate_tracking(ev, users)
    day_ev = filters.filter_local_day(ev, "event_timestamp", DAY, NEXT_DAY, ZONE)
    stale = project.project_tracking_columns(
        joins.join_events_subscribers(day_ev.filter(~filters.C.name_in_set(filters.C.TRACKING_CONTRACT)), users)
    )
    return good.unionByName(stale)


@register("job_tracking_day", _CURATED_SQL)
def q_job_tracking_day(spark, sf):
    """Flagship: replace one local day of the curated table with its rebuild.
    The stale rows of that day go away; every other day is untouched."""
    target = _stale_target(spark, sf)
    return jobs.tracking_day(target, fx.tracking_events(spark, sf), fx.dim_users(spark, sf), DAY, NEXT_DAY, ZONE)


@register("replace_local_day", _CURATED_SQL)
def q_replace_local_day(spark, sf):
    """Delete the day in the target, insert the rebuilt day."""
    target = _stale_target(spark, sf)
    rebuilt = jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf), DAY, NEXT_DAY, ZONE)
    return replace.replace_local_day(target, rebuilt, "timestamp", DAY, NEXT_DAY, ZONE)


@register(
    "agg_count_window",
    f"select count(*)::bigint as row_count from ({_CURATED_SQL}) t "
    f"where {O.local_date('make_timestamp(t.timestamp * 1000)', ZONE)} >= date '{DAY}' "
    f"and {O.local_date('make_timestamp(t.timestamp * 1000)', ZONE)} < date '{NEXT_DAY}'",
)
def q_agg_count_window(spark, sf):
    """``COUNT(*)`` of the refreshed local day in the curated table."""
    curated = jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf))
    in_day = curated.filter(filters.TM.millis_local_date_filter(F.col("timestamp"), DAY, NEXT_DAY, ZONE))
    return in_day.agg(F.count(F.lit(1)).alias("row_count"))


@register("curated_day", _CURATED_DAY_SQL)
def q_curated_day(spark, sf):
    """The rebuilt local day alone (entry's flagship result)."""
    return jobs.curate_tracking(fx.tracking_events(spark, sf), fx.dim_users(spark, sf), DAY, NEXT_DAY, ZONE)
