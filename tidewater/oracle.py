"""DuckDB SQL for the independent correctness check.

Each fixture here is the SQL twin of a function in ``tidewater.fixtures``;
the oracle queries in ``__spark_entry__`` use them as CTEs over the
pre-registered driver views.
"""

from __future__ import annotations

FX_TRACKING = """
fx_b as (select *, cast(json_extract_string(props,'$.k') as int) k from events),
fx_n as (select *, (k // 10) % 2 as h, k % 10 as m, case
  when event_type='signup' then 'session_created'
  when event_type='click' and (k//10)%2=0 then 'quick_buy_sell' when event_type='click' then 'partials_taken'
  when event_type='view' and (k//10)%2=0 then 'replay_activated' when event_type='view' then 'news_visibility_clicked'
  when event_type='purchase' and (k//10)%2=0 then 'order_placed' when event_type='purchase' then 'position_managed'
  else 'app_error' end as name from fx_b),
fx_tracking as (
select event_id, user_id, 'cust_'||user_id as customer_id, ts as event_timestamp, name,
 case when (name='session_created' and m<>3) or (name<>'session_created' and m=0) then 1 end is_session_created,
 case when name='quick_buy_sell' and m=5 then 2 when name='quick_buy_sell' and m<>3 then 1 end is_quick_buy_sell,
 case when name='partials_taken' and m<>3 then 1 end is_partials_taken,
 case when name='position_managed' and m<>3 then 1 when name='quick_buy_sell' and m=5 then -1 end is_position_managed,
 case when name='replay_activated' and m<>3 then 1 when m=4 and name not in ('replay_activated','news_visibility_clicked') then 2 end is_replay_activated,
 case when name='news_visibility_clicked' and m<>3 then 1 when m=4 and name not in ('replay_activated','news_visibility_clicked') then -2 end is_news_visibility_open,
 case when (name='order_placed' and m<>3) or (name='session_created' and m=0) then 1 end is_order_placed,
 case when (name='session_created' and m<>1) or (name='order_placed' and m=2) then 'type_'||(k%3) end created_session_type,
 case when name='quick_buy_sell' and m<>1 then 'buy' end quick_buy_sell_type,
 case when name='partials_taken' and m<>1 then cast(k as varchar) end partials_taken_percentage,
 case when name='partials_taken' then 'pct' end partials_taken_position_amount_type,
 case when name='position_managed' and m<>1 then 'move_sl' end position_managed_type,
 cast(null as varchar) order_has_auto_be, cast(null as varchar) order_has_object_selected, cast(null as varchar) order_has_stop_loss,
 case when name='order_placed' or (name<>'order_placed' and m=2) then cast(k%4 as varchar) end order_tag_count,
 cast(null as varchar) order_has_tag_selected, cast(null as varchar) order_has_take_profit, cast(null as varchar) order_take_profit_type, cast(null as varchar) order_save_type
from fx_n)"""

FX_DIM_USER = """
fx_dim_user as (
select c_custkey as user_id, case when c_custkey%11=0 then null when c_custkey%7=0 then '' else 'sub_'||c_custkey end as last_subscription_id,
 case when c_custkey%13=0 then null when c_mktsegment='BUILDING' then 'BEGINNER-M' else 'PRO-'||c_mktsegment end as last_subscription_plan from customer)"""

FX_ORDERS_FINAL = """
fx_orders_final as (
select o_custkey as id, o_orderkey as order_no, o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as total, o_orderdate as updated_at
 from orders where o_orderdate < timestamp '2000-01-01'
 qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc)=1)"""

FX_ORDERS_RAW = """
fx_orders_raw as (
select o_custkey as id, o_orderkey as "orderNo", o_orderstatus as status, cast(o_totalprice as decimal(18,2)) as total, o_orderdate as "updatedAt"
 from orders where o_orderdate >= timestamp '1999-12-31')"""

FX_NPS_FEED = """
fx_nps_feed as (
select event_id, '{"id":'||case when k%9=8 then 'null' when k%9=7 then '""' else '"e'||(event_id//2)||'"' end||',"name":"'||case when event_type='error' then 'other' else 'appcues:v2:step_interaction' end
 ||'","timestamp":"'||strftime(ts,'%Y-%m-%dT%H:%M:%SZ')||'","user_id":"'||user_id||'","attributes":{"experienceType":"'||case when event_type='view' then 'NPS' else 'modal' end||'","experienceName":"'||case when event_type='click' then 'q1 nps survey' else 'tour' end
 ||'","interactionData":{"surveyResponses":['||case k%8 when 0 then '{"type":"nps_score","value":'||(k%11)||'}' when 1 then '{"type":"nps_score","value":8.9}' when 2 then '{"type":"nps_score","value":" 7 "}' when 3 then '{"type":"nps_score","value":"n/a"}' when 4 then '{"type":"nps_score","value":true},{"type":"nps_score","value":5}' when 5 then '{"type":"nps_score","value":null},{"type":"nps_score","value":6}' when 6 then '{"type":"text","value":"9"}' else '' end||']}}}' as line
 from (select *, cast(json_extract_string(props,'$.k') as int) k from events))"""

# The tracking contract as a relation: per event its flag, the attributes it
# must carry and those it may carry. A row holds when all its flags sum to 1, its
# own flag is 1, and the set of its attributes lies between the two.
_FLAGS = (
    "is_session_created is_quick_buy_sell is_partials_taken is_position_managed is_replay_activated"
    " is_news_visibility_open is_order_placed"
).split()
_ORDER = (
    "order_has_auto_be order_has_object_selected order_has_stop_loss order_tag_count order_has_tag_selected"
    " order_has_take_profit order_take_profit_type order_save_type"
).split()
_ATTRIBUTES = (
    "created_session_type quick_buy_sell_type partials_taken_percentage partials_taken_position_amount_type"
    " position_managed_type"
).split() + _ORDER
_PARTIALS = "['partials_taken_percentage', 'partials_taken_position_amount_type']"


def _names_where(columns: list[str], test: str) -> str:
    """DuckDB list of those of ``columns`` for which ``test`` holds."""
    return "list_filter([" + ", ".join(f"case when {c} {test} then '{c}' end" for c in columns) + "], lambda x: x is not null)"


CONTRACT_WHERE = f"""
 event_id in (
  select t.event_id
  from (select event_id, name, {_names_where(_FLAGS, "= 1")} as flags,
          {" + ".join(f"coalesce({c}, 0)" for c in _FLAGS)} as total, {_names_where(_ATTRIBUTES, "is not null")} as held
        from fx_tracking) t
  join (values
    ('session_created', 'is_session_created', ['created_session_type'], ['created_session_type']),
    ('quick_buy_sell', 'is_quick_buy_sell', ['quick_buy_sell_type'], ['quick_buy_sell_type']),
    ('partials_taken', 'is_partials_taken', {_PARTIALS}, {_PARTIALS}),
    ('position_managed', 'is_position_managed', ['position_managed_type'], ['position_managed_type']),
    ('replay_activated', 'is_replay_activated', []::varchar[], []::varchar[]),
    ('news_visibility_clicked', 'is_news_visibility_open', []::varchar[], []::varchar[]),
    ('order_placed', 'is_order_placed', []::varchar[], {_ORDER})
  ) rule(event, flag, needed, allowed) on rule.event = t.name and list_contains(t.flags, rule.flag) and t.total = 1
  where list_has_all(t.held, rule.needed) and list_has_all(rule.allowed, t.held))"""

ELIGIBLE_WHERE = (
    "last_subscription_id is not null and last_subscription_id <> '' and last_subscription_plan not like '%BEGINNER%'"
)

# Curated tracking projection over fx_tracking joined to eligible users.
TRACKING_SELECT = """
select u.last_subscription_id as subscription_id, u.last_subscription_plan as subscription_plan,
 (epoch_us(e.event_timestamp) // 1000)::bigint as "timestamp", e.name as event_type, e.customer_id, cast(e.user_id as varchar) as user_id,
 cast(e.is_session_created as bigint) is_session_created, cast(e.is_quick_buy_sell as bigint) is_quick_buy_sell,
 cast(e.is_partials_taken as bigint) is_partials_taken, cast(e.is_position_managed as bigint) is_position_managed,
 cast(e.is_replay_activated as bigint) is_replay_activated, cast(e.is_news_visibility_open as bigint) is_news_visibility_clicked,
 cast(e.is_order_placed as bigint) is_order_placed, e.created_session_type, e.quick_buy_sell_type, e.partials_taken_percentage,
 e.partials_taken_position_amount_type, e.position_managed_type, e.order_has_auto_be, e.order_has_object_selected,
 e.order_has_stop_loss, e.order_tag_count, e.order_has_tag_selected, e.order_has_take_profit, e.order_take_profit_type, e.order_save_type"""


def local_date(expr: str, zone: str) -> str:
    """``DATE(ts, zone)`` for a naive UTC timestamp expression, DuckDB form."""
    return f"cast(timezone('{zone}', timezone('UTC', {expr})) as date)"


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join(ctes) + "\n"
