"""Event contracts: which flag and attributes each tracking event owns.

A contract is compiled into one boolean Column, so the whole check runs
inside whole-stage codegen with SQL three-valued logic (a NULL comparison
fails the row, exactly as in a SQL WHERE clause).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventRule:
    name: str
    flag: str
    required: tuple[str, ...] = ()
    owned: tuple[str, ...] = ()


@dataclass(frozen=True)
class EventContract:
    rules: tuple[EventRule, ...]
    name_column: str = "name"
    flags: tuple[str, ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [r.name for r in self.rules]

    @property
    def flag_columns(self) -> list[str]:
        return list(self.flags) or [r.flag for r in self.rules]


# Fixed values that must equal the source system's tracking contract:
# event name, its flag column, the attributes it requires, the attributes only
# it may carry.
_ORDER_ATTRIBUTES = (
    "order_has_auto_be",
    "order_has_object_selected",
    "order_has_stop_loss",
    "order_tag_count",
    "order_has_tag_selected",
    "order_has_take_profit",
    "order_take_profit_type",
    "order_save_type",
)
TRACKING_CONTRACT = EventContract(
    rules=(
        EventRule("session_created", "is_session_created", ("created_session_type",), ("created_session_type",)),
        EventRule("quick_buy_sell", "is_quick_buy_sell", ("quick_buy_sell_type",), ("quick_buy_sell_type",)),
        EventRule(
            "partials_taken",
            "is_partials_taken",
            ("partials_taken_percentage", "partials_taken_position_amount_type"),
            ("partials_taken_percentage", "partials_taken_position_amount_type"),
        ),
        EventRule("position_managed", "is_position_managed", ("position_managed_type",), ("position_managed_type",)),
        EventRule("replay_activated", "is_replay_activated"),
        EventRule("news_visibility_clicked", "is_news_visibility_open"),
        EventRule("order_placed", "is_order_placed", (), _ORDER_ATTRIBUTES),
    ),
    name_column="name",
)


def _q(name: str) -> str:
    return f"`{name}`"


def _s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# The contract is compiled to SQL text and handed to the JVM as one
# expression: building the same tree Column by Column costs hundreds of
# driver round trips per plan.


def name_in_set_sql(contract: EventContract) -> str:
    return f"{_q(contract.name_column)} IN ({', '.join(_s(n) for n in contract.names)})"


def exactly_one_flag_sql(contract: EventContract) -> str:
    """Sum of ``COALESCE(flag, 0)`` over all flags equals 1 (a sum test:
    a flag value of 2 with the others 0 fails, -1 and 2 would pass)."""
    return "(" + " + ".join(f"COALESCE({_q(c)}, 0)" for c in contract.flag_columns) + ") = 1"


def event_contract_sql(contract: EventContract) -> str:
    """Own flag is 1 and own required attributes are present; every attribute
    owned by another event is NULL."""
    name = _q(contract.name_column)
    matches = " OR ".join(
        "(" + " AND ".join([f"{name} = {_s(r.name)}", f"{_q(r.flag)} = 1"] + [f"{_q(a)} IS NOT NULL" for a in r.required]) + ")"
        for r in contract.rules
    )
    exclusive = " AND ".join(
        f"({name} = {_s(r.name)} OR (" + " AND ".join(f"{_q(a)} IS NULL" for a in r.owned) + "))"
        for r in contract.rules
        if r.owned
    )
    return f"({matches})" + (f" AND {exclusive}" if exclusive else "")


def name_in_set(contract: EventContract) -> Column:
    return F.expr(name_in_set_sql(contract))


def exactly_one_flag(contract: EventContract) -> Column:
    return F.expr(exactly_one_flag_sql(contract))


def event_contract(contract: EventContract) -> Column:
    return F.expr(event_contract_sql(contract))


def full_contract(contract: EventContract) -> Column:
    return F.expr(
        f"{name_in_set_sql(contract)} AND {exactly_one_flag_sql(contract)} AND {event_contract_sql(contract)}"
    )
