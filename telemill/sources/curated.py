"""Curated storage: date-partitioned window aggregates and the other per-batch outputs.

Executors write directly. Every micro-batch owns its ``batch_id=N`` directories and overwrites
only those, so a batch that is replayed after a failure leaves one copy, provided that its dates
come from the records (``arrival_date``, ``event_date``) and not from the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemill.operators.changelog import latest_window_state
from telemill.schema import CURATED, WINDOW_COLUMNS

CURATED_DIR = "curated/telemetry"
RAW_DIR = "raw/telemetry"
DEAD_LETTER_DIR = "dead_letter/telemetry"

# JSON output keeps microseconds, and fields that are null.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "ignoreNullFields": "false"}


def today() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d")


def _write_batch(df: DataFrame, path: str, fmt: str, batch_id: int | Column, date: str | Column | None) -> None:
    date = F.lit(today()) if date is None else F.lit(date) if isinstance(date, str) else date
    batch = F.lit(batch_id) if isinstance(batch_id, int) else batch_id
    rows = df.withColumns({"date": date, "batch_id": batch.cast("bigint")})
    if not isinstance(batch_id, int):
        # Many batches at once: AQE sizes the files, small partitions are merged, large ones split.
        rows = rows.hint("rebalance", "date", "batch_id")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch_id")
        .format(fmt)
        .options(**(_JSON if fmt == "json" else {}))
        .save(path)
    )


def write_curated(
    windows: DataFrame, base: str, batch_id: int | Column, date: str | Column | None = None
) -> str:
    """Window aggregates as Parquet under ``date=D/batch_id=N``; an empty batch writes nothing.

    ``date`` is the processing date unless given; pass ``event_date()`` to partition by the date
    of the window, which makes date predicates prune safely for replays too.
    """
    path = f"{base}/{CURATED_DIR}"
    _write_batch(windows.select(*WINDOW_COLUMNS, *_own(windows, batch_id)), path, "parquet", batch_id, date)
    return path


def _own(df: DataFrame, batch_id: int | Column) -> list[str]:
    return [] if isinstance(batch_id, int) else ["batch_id"]


def event_date() -> Column:
    return F.date_format("window_start", "yyyy-MM-dd")


def arrival_date() -> Column:
    """Date of arrival at the broker; unlike the clock it is the same when a batch is replayed."""
    return F.coalesce(F.date_format("kafka_timestamp", "yyyy-MM-dd"), F.lit("unknown"))


def write_raw(records: DataFrame, base: str, batch_id: int | Column, date: str | Column | None = None) -> str:
    """Records as line-delimited JSON under the raw prefix."""
    path = f"{base}/{RAW_DIR}"
    _write_batch(records, path, "json", batch_id, date)
    return path


def write_dead_letter(rejected: DataFrame, base: str, batch_id: int | Column, date: str | Column | None = None) -> str:
    path = f"{base}/{DEAD_LETTER_DIR}"
    _write_batch(rejected, path, "parquet", batch_id, date)
    return path


def write_json_batch(df: DataFrame, base: str, batch_id: int, prefix: str = "aggregated") -> str:
    """Whole batch as line-delimited JSON under ``prefix/batch-N``."""
    path = f"{base}/{prefix}/batch-{batch_id}"
    df.hint("rebalance").write.mode("overwrite").options(**_JSON).json(path)
    return path


def read_curated(spark: SparkSession, base: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """The changelog as stored; ``dates`` (first, last) prunes partitions."""
    rows = spark.read.schema(CURATED).parquet(f"{base}/{CURATED_DIR}")
    return rows if dates is None else rows.filter(F.col("date").between(*dates))


def read_state(spark: SparkSession, base: str) -> DataFrame:
    """Latest state per window; what analytics should read."""
    return latest_window_state(read_curated(spark, base))


def write_state(state: DataFrame, path: str) -> None:
    """Store the compacted state, for many analytics to read instead of compacting each.

    Rows are laid out by window start, so predicates on recent windows skip files and row groups.
    """
    laid_out = state.repartitionByRange("window_start", "vehicle_id").sortWithinPartitions("window_start", "vehicle_id")
    laid_out.write.mode("overwrite").parquet(path)


# --- catalog -------------------------------------------------------------------------------


def create_database(spark: SparkSession, base: str, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{base}/{database}.db'")


def create_curated_table(spark: SparkSession, base: str, database: str, table: str = "telemetry_aggregates") -> str:
    """Database and external table over the curated folder, for SQL users."""
    name = f"`{database}`.`{table}`"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CURATED)
    create_database(spark, base, database)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (date, batch_id) LOCATION '{base}/{CURATED_DIR}'"
    )
    return name


def repair_table(spark: SparkSession, name: str) -> None:
    """Register partitions written since the last call."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def _required(windows: DataFrame) -> DataFrame:
    key = ("vehicle_id", "window_start", "window_end")
    required = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} must not be null"))) for c in key}
    return windows.select(*WINDOW_COLUMNS).withColumns(required)


def append_table(windows: DataFrame, name: str) -> None:
    """Append aggregates to a managed table, created when absent; the key columns must be set.

    Called again for the same rows it adds them again; ``append_batch`` does not.
    """
    _required(windows).write.mode("append").saveAsTable(name)


def append_batch(windows: DataFrame, name: str, batch_id: int) -> None:
    """One micro-batch's aggregates in a managed table, created when absent; the key columns must be set.

    The table is partitioned by ``batch_id`` and a batch replaces its own partition as a whole, so one
    that is replayed leaves one copy. An empty batch leaves an empty partition.
    """
    spark = windows.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CURATED if f.name not in ("date", "batch_id"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id)")
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch_id = {int(batch_id)}) SELECT * FROM {{rows}}", rows=_required(windows))
