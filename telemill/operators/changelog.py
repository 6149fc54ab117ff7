"""Update-mode output is a changelog: a window is written again each time it changes. These
operators produce, compact and compare such changelogs."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from telemill.config import DEFAULT_WINDOW
from telemill.operators.windows import is_fault
from telemill.schema import WINDOW_COLUMNS, WINDOW_KEY


def update_changelog(
    events: DataFrame, window_duration: str = DEFAULT_WINDOW, batch: str = "batch_id", fault=None
) -> DataFrame:
    """What update mode would emit for events that arrived in the given micro-batches.

    Each batch emits the cumulative aggregate of every window it touched. Events are first
    reduced to one row per window and batch; only those rows are accumulated.
    """
    # Start and end as columns of their own: accumulation and a later compaction then share one
    # partitioning, and filters on a bound travel down to the events.
    windowed = events.withColumn("_window", F.window("event_timestamp", window_duration)).withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    )
    partial = windowed.groupBy(*WINDOW_KEY, F.col(batch).cast("bigint").alias("batch_id")).agg(
        F.sum("speed").alias("speed"),
        F.sum("battery_level").alias("battery"),
        F.max("temperature").alias("temperature"),
        F.sum(is_fault() if fault is None else fault).alias("faults"),
        F.count(F.lit(1)).alias("events"),
    )
    so_far = (
        Window.partitionBy(*WINDOW_KEY)
        .orderBy("batch_id")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    count = F.sum("events").over(so_far)
    return partial.select(
        *WINDOW_KEY,
        (F.sum("speed").over(so_far) / count).alias("average_speed"),
        (F.sum("battery").over(so_far) / count).alias("average_battery_level"),
        F.max("temperature").over(so_far).alias("maximum_temperature"),
        F.sum("faults").over(so_far).alias("fault_count"),
        count.alias("event_count"),
        "batch_id",
    )


def latest_window_state(changelog: DataFrame) -> DataFrame:
    """Latest row per window; within one batch the row that saw most events.

    Filters on measures belong above this operator (an older row must not win because the newer
    one was filtered away); filters on the window key pass through it to the scan by themselves.
    """
    newest = Window.partitionBy(*WINDOW_KEY).orderBy(F.desc("batch_id"), F.desc("event_count"))
    return (
        changelog.withColumn("_nth", F.row_number().over(newest))
        .filter("_nth = 1")
        .select(*WINDOW_COLUMNS, "batch_id")
    )


def batch_filter(state: DataFrame, batch_id: int | None = None) -> DataFrame:
    """Rows last written by one micro-batch; all rows when none is named."""
    return state if batch_id is None else state.filter(F.col("batch_id") == batch_id)


def batch_counts(state: DataFrame) -> DataFrame:
    """Rows per micro-batch, newest first; rows of unknown batch are left out."""
    return (
        state.filter(F.col("batch_id").isNotNull())
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("batch_id"))
    )


def snapshot_diff(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Windows that appeared (``new``) or gained events (``updated``) since ``previous``.

    The very first snapshot (``previous`` is None) has nothing to differ from: no rows. Rows without
    a complete key are left out.
    """
    if previous is None:
        return current.withColumn("change", F.lit("new")).filter(F.lit(False))
    # The same filter on both sides keeps the plans of two snapshots of one changelog alike, and
    # equality of the whole key lets the join take over their partitioning.
    complete = reduce(and_, [F.col(k).isNotNull() for k in WINDOW_KEY])
    current, previous = current.filter(complete), previous.filter(complete)
    before = previous.select(*[F.col(k).alias(f"_{k}") for k in WINDOW_KEY], F.col("event_count").alias("_before"))
    same = reduce(and_, [F.col(k) == F.col(f"_{k}") for k in WINDOW_KEY])
    change = F.when(F.col("_before").isNull(), "new").when(F.col("event_count") > F.col("_before"), "updated")
    return (
        current.join(before, same, "left")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .drop("_before", *[f"_{k}" for k in WINDOW_KEY])
    )


def new_window_count(diff: DataFrame) -> DataFrame:
    """How many windows appeared (one row); above zero means the table grew."""
    return diff.agg(F.count_if(F.col("change") == "new").alias("new_windows"))
