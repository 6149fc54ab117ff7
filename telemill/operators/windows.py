"""Tumbling event-time windows per vehicle. Every buffer is fixed width: partial hash aggregation
shrinks the data before the only exchange, however hot one vehicle is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telemill.config import DEFAULT_WINDOW, MEASURES, NO_FAULT
from telemill.functions import numbers, times
from telemill.operators.dedup import first_measures
from telemill.schema import WINDOW_COLUMNS


def is_fault(code: str = "fault_code") -> Column:
    return F.when(F.col(code) != NO_FAULT, 1).otherwise(0).cast("bigint")


def is_fault_any_case(code: str = "fault_code") -> Column:
    """Lenient form: case does not matter, an absent code is no fault."""
    return F.when(F.upper(F.col(code)) != NO_FAULT, 1).otherwise(0).cast("bigint")


def flatten_window(windowed: DataFrame) -> DataFrame:
    """``window`` struct as start and end columns, in the table's column order."""
    bounds = {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    return windowed.select(*[bounds[c].alias(c) if c in bounds else c for c in WINDOW_COLUMNS])


def window_kpis(
    events: DataFrame, window_duration: str = DEFAULT_WINDOW, fault: Column | None = None
) -> DataFrame:
    """KPIs per vehicle and window; works on batch and on watermarked streaming frames."""
    windowed = events.groupBy(F.window("event_timestamp", window_duration), "vehicle_id").agg(
        F.avg("speed").alias("average_speed"),
        F.avg("battery_level").alias("average_battery_level"),
        F.max("temperature").alias("maximum_temperature"),
        F.sum(is_fault() if fault is None else fault).alias("fault_count"),
        F.count(F.lit(1)).alias("event_count"),
    )
    return flatten_window(windowed)


def deduplicated_measures(valid: DataFrame, arrival: str, extra: Sequence[str] = ()) -> DataFrame:
    """What the window KPIs need of each event, first arrivals only (batch)."""
    narrow = valid.select("vehicle_id", "event_timestamp", *MEASURES, is_fault().alias("fault"), *extra, arrival)
    return first_measures(narrow, arrival, [*MEASURES, "fault", *extra])


def batch_window_kpis(valid: DataFrame, arrival: str, window_duration: str = DEFAULT_WINDOW) -> DataFrame:
    """Batch twin of dedup + aggregate of the streaming job."""
    return window_kpis(deduplicated_measures(valid, arrival), window_duration, F.col("fault"))


def window_kpis_rounded(events: DataFrame, window_seconds: int = 300) -> DataFrame:
    """Window summaries of normalised events (``timestamp`` as ISO text), averages to 2 digits.

    Sorted by vehicle and window. Grouping is by instant, whatever offset a record carries.
    """
    if window_seconds <= 0:
        raise ValueError("window_seconds must be positive")
    instants = events.withColumn("event_timestamp", times.event_time(F.col("timestamp")))
    summary = window_kpis(instants, f"{window_seconds} seconds", is_fault_any_case())
    return sorted_windows(
        summary.select(
            "vehicle_id",
            times.as_iso(F.col("window_start")).alias("window_start"),
            F.lit(window_seconds).alias("window_seconds"),
            numbers.round_2(F.col("average_speed")).alias("avg_speed"),
            numbers.round_2(F.col("average_battery_level")).alias("avg_battery_level"),
            F.col("maximum_temperature").alias("max_temperature"),
            "fault_count",
            "event_count",
        )
    )


def sorted_windows(windows: DataFrame) -> DataFrame:
    return windows.orderBy("vehicle_id", "window_start")
