"""Replication table configs: the metadata that drives the replicate job."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidewater.functions.naming import validate_identifier


@dataclass(frozen=True)
class TableConfig:
    task_name: str
    source_table: str
    final_table: str
    join_keys: tuple[str, ...]
    partition_by: tuple[str, ...]
    order_by: tuple[tuple[str, str], ...]
    source_incremental_column: str | None = None
    target_incremental_column: str | None = None
    delete_not_matched_by_source: bool = False
    unix_seconds_columns: tuple[str, ...] = field(default=())

    def __post_init__(self):
        for name in (self.source_table, self.final_table, *self.join_keys, *self.partition_by):
            validate_identifier(name)
        for col, direction in self.order_by:
            validate_identifier(col)
            if direction.upper() not in ("ASC", "DESC"):
                raise ValueError(f"bad direction {direction!r}")
        if not self.join_keys or not self.partition_by or not self.order_by:
            raise ValueError("join_keys, partition_by and order_by must be non-empty")
        if (self.source_incremental_column is None) != (self.target_incremental_column is None):
            raise ValueError("source and target incremental columns must both be set or both unset")

    @property
    def is_snapshot(self) -> bool:
        return self.source_incremental_column is None


def _desc(*cols: str) -> tuple[tuple[str, str], ...]:
    return tuple((c, "DESC") for c in cols)


# The seven replicated tables of the relational source.
TABLE_CONFIGS = (
    TableConfig("timeanalytic", "timeanalytic", "time_analytics", ("user_id", "date"), ("user_id", "date"),
                _desc("updated_at"), "updatedAt", "updated_at"),
    TableConfig("positions", "position", "positions", ("id",), ("id",),
                _desc("updated_at", "_loaded_at"), "updatedAt", "updated_at"),
    TableConfig("emaillead", "emaillead", "email_leads", ("id",), ("id",),
                _desc("created_at", "_loaded_at"), "createdAt", "created_at"),
    TableConfig("symbol_library", "symbollibrary", "symbol_library", ("id",), ("id",),
                _desc("_loaded_at"), None, None, True),
    TableConfig("backtesting_sessions", "backtestingsession", "backtesting_sessions", ("id",), ("id",),
                _desc("updated_at", "_loaded_at"), "updatedAt", "updated_at"),
    TableConfig("users", "user", "users", ("id",), ("id",),
                _desc("_loaded_at"), None, None, True),
    TableConfig("orders", "order", "orders", ("id",), ("id",),
                _desc("updated_at", "_loaded_at"), "updatedAt", "updated_at",
                unix_seconds_columns=("placingTime", "executionTime", "autoBreakEvenTriggeredAt")),
)
CONFIGS_BY_NAME = {c.task_name: c for c in TABLE_CONFIGS}


@dataclass(frozen=True)
class AdsStream:
    """A stream of the ads API: ``metadata`` is loaded whole each run,
    ``insights`` day by day behind a bookmark."""

    stream_name: str
    stream_type: str
    breakdowns: tuple[str, ...] = ()
    bookmark_field: str | None = None

    def __post_init__(self):
        validate_identifier(self.stream_name)
        if self.stream_type not in ("metadata", "insights"):
            raise ValueError(f"stream type must be metadata or insights, not {self.stream_type!r}")
        if (self.stream_type == "insights") != (self.bookmark_field is not None):
            raise ValueError("insights have a bookmark field, metadata have none")


def _insights(name: str, *breakdowns: str) -> AdsStream:
    return AdsStream(name, "insights", breakdowns, "date_start")


# The ten streams of the ads API and their breakdowns.
ADS_STREAMS = (
    AdsStream("adcreative", "metadata"),
    AdsStream("ads", "metadata"),
    AdsStream("adsets", "metadata"),
    AdsStream("campaigns", "metadata"),
    _insights("ads_insights"),
    _insights("ads_insights_age_and_gender", "age", "gender"),
    _insights("ads_insights_country", "country"),
    _insights("ads_insights_platform_and_device", "publisher_platform", "platform_position", "impression_device"),
    _insights("ads_insights_region", "region"),
    _insights("ads_insights_dma", "dma"),
)
ADS_BY_NAME = {s.stream_name: s for s in ADS_STREAMS}
