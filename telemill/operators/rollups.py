"""Mergeable partial aggregates of the state by vehicle, and the fleet reports made of them.

A report over rollups reads one row per vehicle and part (such as a date) instead of every window. Counts,
sums and extremes merge exactly; vehicles are counted exactly, as each has its own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from telemill.functions import numbers, times
from telemill.functions.numbers import round_2

ROLLUP = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in ("windows", "fault_windows", "events", "faults", "speeds", "batteries")],
        *[T.StructField(c, T.DoubleType()) for c in ("speed_sum", "battery_sum", "battery_min", "battery_max", "temperature_max")],
        *[T.StructField(c, T.TimestampType()) for c in ("first_start", "last_start", "last_end")],
    ]
)


def vehicle_rollups(state: DataFrame, *part: str) -> DataFrame:
    """``ROLLUP`` of the state by vehicle and the ``part`` columns."""
    return state.groupBy(*part, "vehicle_id").agg(
        F.count(F.lit(1)).alias("windows"),
        F.count_if(F.col("fault_count") > 0).alias("fault_windows"),
        F.sum("event_count").alias("events"),
        F.sum("fault_count").alias("faults"),
        F.count("average_speed").alias("speeds"),
        F.count("average_battery_level").alias("batteries"),
        F.sum("average_speed").alias("speed_sum"),
        F.sum("average_battery_level").alias("battery_sum"),
        F.min("average_battery_level").alias("battery_min"),
        F.max("average_battery_level").alias("battery_max"),
        F.max("maximum_temperature").alias("temperature_max"),
        F.min("window_start").alias("first_start"),
        F.max("window_start").alias("last_start"),
        F.max("window_end").alias("last_end"),
    )


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def vehicle_speed_summary(rollups: DataFrame) -> DataFrame:
    summary = rollups.groupBy("vehicle_id").agg(
        round_2(_mean("speed_sum", "speeds")).alias("overall_avg_speed_kmh"),
        F.sum("windows").alias("total_windows"),
        F.sum("events").alias("total_events"),
    )
    return summary.orderBy(F.desc("overall_avg_speed_kmh"), "vehicle_id")


def vehicle_battery_summary(rollups: DataFrame) -> DataFrame:
    summary = rollups.groupBy("vehicle_id").agg(
        round_2(_mean("battery_sum", "batteries")).alias("overall_avg_battery_pct"),
        F.min("battery_min").alias("min_battery_pct"),
        F.max("battery_max").alias("max_battery_pct"),
    )
    return summary.orderBy("overall_avg_battery_pct", "vehicle_id")


def vehicle_max_temp(rollups: DataFrame) -> DataFrame:
    summary = rollups.groupBy("vehicle_id").agg(F.max("temperature_max").alias("all_time_max_temp_celsius"))
    return summary.orderBy(F.desc("all_time_max_temp_celsius"), "vehicle_id")


def vehicle_fault_distribution(rollups: DataFrame) -> DataFrame:
    totals = rollups.groupBy("vehicle_id").agg(F.sum("faults").alias("total_faults"), F.sum("events").alias("total_events"))
    rate = numbers.fault_rate_pct(F.col("total_faults"), F.col("total_events"))
    return totals.withColumn("fault_rate_pct", rate).orderBy(F.desc("total_faults"), "vehicle_id")


def latest_window_per_vehicle(rollups: DataFrame) -> DataFrame:
    summary = rollups.groupBy("vehicle_id").agg(
        F.max("last_end").alias("latest_window_end"), F.max("last_start").alias("latest_window_start")
    )
    return summary.orderBy(F.desc("latest_window_end"), "vehicle_id")


def table_totals(rollups: DataFrame) -> DataFrame:
    return rollups.agg(
        F.coalesce(F.sum("windows"), F.lit(0).cast("bigint")).alias("total_windows"),
        F.min("first_start").alias("earliest_window"),
        F.max("last_end").alias("latest_window"),
    )


def fleet_summary(rollups: DataFrame) -> DataFrame:
    """The KPIs of ``analytics.fleet_summary``; zeros (and null bounds) without rollups."""
    none, nothing = F.lit(0).cast("bigint"), F.lit(0.0)
    return rollups.agg(
        F.countDistinct("vehicle_id").alias("total_vehicles"),
        F.coalesce(F.sum("windows"), none).alias("total_windows"),
        F.coalesce(F.sum("events"), none).alias("total_events"),
        F.coalesce(F.sum("faults"), none).alias("total_faults"),
        F.coalesce(round_2(_mean("speed_sum", "speeds")), nothing).alias("avg_speed"),
        F.coalesce(round_2(_mean("battery_sum", "batteries")), nothing).alias("avg_battery"),
        F.coalesce(round_2(F.max("temperature_max")), nothing).alias("max_temperature"),
        times.as_text(F.min("first_start")).alias("earliest_window"),
        times.as_text(F.max("last_end")).alias("latest_window"),
    )
