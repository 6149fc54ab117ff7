"""Status of a window as dashboards show it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemill.config import HOT_TEMPERATURE, LOW_BATTERY


def _faults() -> Column:
    return F.coalesce(F.col("fault_count"), F.lit(0))


def _needs_attention() -> Column:
    hot = F.coalesce(F.col("maximum_temperature"), F.lit(0.0)) > HOT_TEMPERATURE
    # A battery of exactly 0 counts like a missing one, i.e. as full.
    battery = F.coalesce(F.nullif(F.col("average_battery_level"), F.lit(0.0)), F.lit(100.0))
    return hot | (battery < LOW_BATTERY)


def status_level() -> Column:
    return F.when(_faults() > 0, "fault").when(_needs_attention(), "warning").otherwise("ok")


def status_label() -> Column:
    noun = F.when(_faults() > 1, " Faults").otherwise(" Fault")
    return (
        F.when(_faults() > 0, F.concat(_faults().cast("string"), noun))
        .when(_needs_attention(), "Warning")
        .otherwise("Nominal")
    )
