"""Fleet analytics over the compacted window aggregates.

Input is the latest state per window (``changelog.latest_window_state``), never the raw
changelog. Every ordering ends in the window key, so it is total: results are repeatable and a
range-partitioned sort splits evenly even when many rows share the leading value.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from telemill.config import HOT_TEMPERATURE
from telemill.functions import numbers, status, times
from telemill.functions.numbers import round_2
from telemill.schema import WINDOW_COLUMNS

SORTABLE = (
    "batch_id",
    "vehicle_id",
    "window_start",
    "average_speed",
    "average_battery_level",
    "maximum_temperature",
    "fault_count",
    "event_count",
)


def _check_limit(limit: int, top: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= top:
        raise ValueError(f"limit must be an integer from 1 to {top}")
    return limit


# --- per window ----------------------------------------------------------------------------


def recent_window_metrics(state: DataFrame, limit: int = 50) -> DataFrame:
    """Newest windows with rounded metrics."""
    return (
        state.orderBy(F.desc("window_start"), "vehicle_id", "window_end")
        .limit(limit)
        .select(
            "vehicle_id",
            "window_start",
            "window_end",
            round_2(F.col("average_speed")).alias("avg_speed_kmh"),
            round_2(F.col("average_battery_level")).alias("avg_battery_pct"),
            round_2(F.col("maximum_temperature")).alias("max_temp_celsius"),
            "fault_count",
            "event_count",
        )
    )


def recent_windows(state: DataFrame, as_of: Column | dt.datetime | None = None, minutes: int = 30) -> DataFrame:
    """Windows that ended within ``minutes`` before ``as_of`` (default: now), newest first."""
    if as_of is None:
        as_of = F.current_timestamp()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    since = as_of - F.make_dt_interval(mins=F.lit(minutes))
    return (
        state.filter(F.col("window_end") >= since)
        .select(
            "vehicle_id",
            "window_start",
            "window_end",
            round_2(F.col("average_speed")).alias("avg_speed_kmh"),
            round_2(F.col("average_battery_level")).alias("avg_battery_pct"),
            "fault_count",
            "event_count",
        )
        .orderBy(F.desc("window_end"), "vehicle_id", "window_start")
    )


def high_temp_windows(state: DataFrame, threshold: float = HOT_TEMPERATURE) -> DataFrame:
    """Windows above a temperature, hottest first."""
    return (
        state.filter(F.col("maximum_temperature") > threshold)
        .select("vehicle_id", "window_start", "window_end", "maximum_temperature")
        .orderBy(F.desc("maximum_temperature"), "window_start", "vehicle_id", "window_end")
    )


def fault_windows(state: DataFrame) -> DataFrame:
    """Windows with faults and their fault rate, most faults first."""
    return (
        state.filter(F.col("fault_count") > 0)
        .select(
            "vehicle_id",
            "window_start",
            "window_end",
            "fault_count",
            "event_count",
            numbers.fault_rate_pct(F.col("fault_count"), F.col("event_count"), 1).alias("fault_rate_pct"),
        )
        .orderBy(F.desc("fault_count"), "window_start", "vehicle_id", "window_end")
    )


def window_status(state: DataFrame) -> DataFrame:
    """Every window with its status level and label."""
    return state.withColumns({"status": status.status_level(), "status_label": status.status_label()})


def _as_served(state: DataFrame) -> DataFrame:
    stamps = {c: times.as_text(F.col(c)) for c in ("window_start", "window_end")}
    return state.select(*WINDOW_COLUMNS).withColumns(stamps)


def latest_telemetry(state: DataFrame, limit: int = 100) -> DataFrame:
    """The newest windows as served to clients, timestamps as text."""
    _check_limit(limit, 1000)
    newest = state.orderBy(F.desc("window_start"), "vehicle_id", "window_end").limit(limit)
    return _as_served(newest)


def latest_telemetry_desc(state: DataFrame, limit: int = 100) -> DataFrame:
    """Variant with vehicles in descending order within a window."""
    return state.orderBy(F.desc("window_start"), F.desc("vehicle_id"), F.desc("window_end")).limit(limit)


def recent_faults(state: DataFrame, limit: int = 50) -> DataFrame:
    """The newest windows with faults as served to clients."""
    _check_limit(limit, 500)
    newest = (
        state.filter(F.col("fault_count") > 0)
        .orderBy(F.desc("window_start"), F.desc("fault_count"), "vehicle_id", "window_end")
        .limit(limit)
    )
    return _as_served(newest)


def top_faults(state: DataFrame) -> DataFrame:
    """First ten of the recent fault list."""
    return recent_faults(state, 10)


def sort_by_column(state: DataFrame, column: str = "window_start", descending: bool = True) -> DataFrame:
    """Order by any sortable column; missing numbers sort as -1, missing text as ''."""
    if column not in SORTABLE:
        raise ValueError(f"cannot sort by {column!r}; choose one of {', '.join(SORTABLE)}")
    if column == "window_start":
        key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    else:
        key = F.coalesce(F.col(column), F.lit("" if column == "vehicle_id" else -1))
    lead = key.desc() if descending else key.asc()
    return state.orderBy(lead, F.desc("window_start"), "vehicle_id", "window_end")


# --- per vehicle ---------------------------------------------------------------------------


def vehicle_speed_summary(state: DataFrame) -> DataFrame:
    return (
        state.groupBy("vehicle_id")
        .agg(
            round_2(F.avg("average_speed")).alias("overall_avg_speed_kmh"),
            F.count(F.lit(1)).alias("total_windows"),
            F.sum("event_count").alias("total_events"),
        )
        .orderBy(F.desc("overall_avg_speed_kmh"), "vehicle_id")
    )


def vehicle_battery_summary(state: DataFrame) -> DataFrame:
    return (
        state.groupBy("vehicle_id")
        .agg(
            round_2(F.avg("average_battery_level")).alias("overall_avg_battery_pct"),
            F.min("average_battery_level").alias("min_battery_pct"),
            F.max("average_battery_level").alias("max_battery_pct"),
        )
        .orderBy("overall_avg_battery_pct", "vehicle_id")
    )


def vehicle_max_temp(state: DataFrame) -> DataFrame:
    return (
        state.groupBy("vehicle_id")
        .agg(F.max("maximum_temperature").alias("all_time_max_temp_celsius"))
        .orderBy(F.desc("all_time_max_temp_celsius"), "vehicle_id")
    )


def vehicle_fault_distribution(state: DataFrame) -> DataFrame:
    totals = state.groupBy("vehicle_id").agg(
        F.sum("fault_count").alias("total_faults"), F.sum("event_count").alias("total_events")
    )
    rate = numbers.fault_rate_pct(F.col("total_faults"), F.col("total_events"))
    return totals.withColumn("fault_rate_pct", rate).orderBy(F.desc("total_faults"), "vehicle_id")


def latest_window_per_vehicle(state: DataFrame) -> DataFrame:
    return (
        state.groupBy("vehicle_id")
        .agg(F.max("window_end").alias("latest_window_end"), F.max("window_start").alias("latest_window_start"))
        .orderBy(F.desc("latest_window_end"), "vehicle_id")
    )


# --- whole fleet ---------------------------------------------------------------------------


def table_totals(state: DataFrame) -> DataFrame:
    return state.agg(
        F.count(F.lit(1)).alias("total_windows"),
        F.min("window_start").alias("earliest_window"),
        F.max("window_end").alias("latest_window"),
    )


def fleet_summary(state: DataFrame) -> DataFrame:
    """One row of KPIs; zeros (and null bounds) on an empty table.

    The averages weigh every window the same, however many events it holds.
    """
    none, nothing = F.lit(0).cast("bigint"), F.lit(0.0)
    return state.agg(
        F.countDistinct("vehicle_id").alias("total_vehicles"),
        F.count(F.lit(1)).alias("total_windows"),
        F.coalesce(F.sum("event_count"), none).alias("total_events"),
        F.coalesce(F.sum("fault_count"), none).alias("total_faults"),
        F.coalesce(round_2(F.avg("average_speed")), nothing).alias("avg_speed"),
        F.coalesce(round_2(F.avg("average_battery_level")), nothing).alias("avg_battery"),
        F.coalesce(round_2(F.max("maximum_temperature")), nothing).alias("max_temperature"),
        times.as_text(F.min("window_start")).alias("earliest_window"),
        times.as_text(F.max("window_end")).alias("latest_window"),
    )


def fault_kpis(state: DataFrame) -> DataFrame:
    """Total faults, vehicles affected, windows with faults (one row)."""
    return state.filter(F.col("fault_count") > 0).agg(
        F.coalesce(F.sum("fault_count"), F.lit(0).cast("bigint")).alias("total_faults"),
        F.countDistinct("vehicle_id").alias("affected_vehicles"),
        F.count(F.lit(1)).alias("fault_windows"),
    )


def fault_vehicles(state: DataFrame) -> DataFrame:
    """The affected vehicles, one row each and sorted (a list column would not be bounded)."""
    return state.filter(F.col("fault_count") > 0).select("vehicle_id").distinct().orderBy("vehicle_id")


# --- result rows that arrive as text -------------------------------------------------------


def typed_projection(rows: DataFrame) -> DataFrame:
    """Re-type an all-text query result; what cannot be read becomes 0 or ''."""
    makers = {"double": numbers.or_zero, "bigint": numbers.or_zero_int, "string": numbers.or_empty}
    types = {
        "vehicle_id": "string",
        "window_start": "string",
        "window_end": "string",
        "average_speed": "double",
        "average_battery_level": "double",
        "maximum_temperature": "double",
        "fault_count": "bigint",
        "event_count": "bigint",
    }
    return rows.select(*[makers[t](F.col(c)).alias(c) for c, t in types.items()])
