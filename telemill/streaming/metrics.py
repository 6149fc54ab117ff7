"""Operational counters as rows: one set of five per micro-batch, and a status flag."""

from __future__ import annotations

import logging
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from telemill.sources.curated import today

logger = logging.getLogger(__name__)

METRICS_DIR = "metrics"
# Metric names dashboards and alarms are keyed on (fixed values).
COUNTERS = {
    "batches_processed": "BatchesProcessed",
    "records_processed": "RecordsProcessed",
    "aggregated_records": "AggregatedRecords",
    "invalid_records": "InvalidRecords",
    "pipeline_errors": "PipelineErrors",
}
STATUS = "ApplicationStatus"


def to_metric_rows(counts: DataFrame) -> DataFrame:
    """``(batch_id, <five counters>)`` to long form ``(batch_id, metric, value, unit)``."""
    pairs = ", ".join(f"'{name}', CAST({column} AS DOUBLE)" for column, name in COUNTERS.items())
    return counts.selectExpr(
        "batch_id", f"stack({len(COUNTERS)}, {pairs}) AS (metric, value)", "'Count' AS unit"
    )


def batch_counts(source: DataFrame, **counters: Column | int) -> DataFrame:
    """Counts per ``batch_id``; counters not given are 0."""
    given = {k: v if isinstance(v, Column) else F.lit(v) for k, v in counters.items()}
    return source.groupBy("batch_id").agg(
        *[given.get(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTERS]
    )


def metrics_by_batch(flagged: DataFrame, changelog: DataFrame) -> DataFrame:
    """All five counters of each micro-batch, from what it received and what it emitted.

    Each side is reduced to one row per batch before they meet.
    """
    received = batch_counts(
        flagged,
        records_processed=F.count(F.lit(1)),
        invalid_records=F.count_if(~F.col("is_valid")),
    )
    emitted = batch_counts(changelog, batches_processed=1, aggregated_records=F.count(F.lit(1)))
    merged = received.unionByName(emitted).groupBy("batch_id").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return to_metric_rows(merged)


def _append(rows: DataFrame, path: str, mode: str = "append") -> None:
    """Metrics never stop the data flow: a failed write is only logged."""
    try:
        rows.coalesce(1).write.mode(mode).parquet(path)
    except Exception:
        logger.warning("could not write metrics to %s", path, exc_info=True)


def put(spark: SparkSession, base: str, name: str, value: float, unit: str = "Count") -> None:
    """Write one point of any metric, next to all earlier ones."""
    row = spark.range(1).select(
        F.lit(None).cast("bigint").alias("batch_id"),
        F.lit(name).alias("metric"),
        F.lit(float(value)).alias("value"),
        F.lit(unit).alias("unit"),
    )
    _append(row, f"{base}/{METRICS_DIR}/date={today()}/query=points/slot={uuid.uuid4().hex}")


def emit_error(spark: SparkSession, base: str) -> None:
    """Count one failure of the job."""
    put(spark, base, COUNTERS["pipeline_errors"], 1)


#: Micro-batches of one query and day that share a file.
SLOT = 100
POINT = "batch_id bigint, metric string, value double, unit string"


class Ledger:
    """Rows of micro-batches under ``folder/date=D/query=Q/slot=S``, one file for ``SLOT`` batches.

    A day has one file for every ``SLOT`` batches, however short they are. Each batch writes its slot's
    few rows again; a replayed batch replaces its own. After a restart the slot is read back first.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str = POINT):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.held: dict[str, dict[int, list[tuple]]] = {}

    def _load(self, path: str) -> dict[int, list[tuple]]:
        found: dict[int, list[tuple]] = {}
        try:
            rows = self.spark.read.schema(self.schema).parquet(path).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = []
        for row in rows:
            found.setdefault(row.batch_id, []).append(tuple(row))
        return found

    def put(self, query: str, batch_id: int, date: str | None, rows: list[tuple]) -> None:
        """Store a batch's rows, whose first column is its id; a failure is only logged."""
        path = f"{self.folder}/date={date or 'unknown'}/query={query}/slot={batch_id // SLOT}"
        try:
            if path not in self.held:
                self.held = dict([*self.held.items()][-3:]) | {path: self._load(path)}
            self.held[path][batch_id] = rows
            every = [row for batch in self.held[path].values() for row in batch]
            self.spark.createDataFrame(every, self.schema).coalesce(1).write.mode("overwrite").parquet(path)
        except Exception:
            logger.warning("could not write %s", path, exc_info=True)


def emit_batch_metrics(
    spark: SparkSession, base: str, query: str, batch_id: int, date: str | None = None, ledger: Ledger | None = None, **counters: int
) -> None:
    """Write one micro-batch's five counters; a replayed batch of the same date replaces its own.

    A query that passes its ``ledger`` every time need not read the slot back.
    """
    rows = [(batch_id, name, float(counters.get(column, 0)), "Count") for column, name in COUNTERS.items()]
    (ledger or Ledger(spark, f"{base}/{METRICS_DIR}")).put(query, batch_id, date, rows)


def emit_status(spark: SparkSession, base: str, running: bool) -> None:
    """1 when the job starts, 0 when it ends."""
    row = spark.range(1).select(
        F.lit(None).cast("bigint").alias("batch_id"),
        F.lit(STATUS).alias("metric"),
        F.lit(1.0 if running else 0.0).alias("value"),
        F.lit("Count").alias("unit"),
    )
    _append(row, f"{base}/{METRICS_DIR}/date={today()}/query=status/slot={uuid.uuid4().hex}")


def read_metrics(spark: SparkSession, base: str, dates: tuple[str, str] | None = None) -> DataFrame:
    """All points; ``dates`` (first, last) prunes days. A micro-batch's day is that of its newest record."""
    schema = f"{POINT}, date string, query string, slot string"
    rows = spark.read.schema(schema).parquet(f"{base}/{METRICS_DIR}").drop("slot")
    return rows if dates is None else rows.filter(F.col("date").between(*dates))


# --- what became of the rows of each micro-batch -----------------------------------------------

ACCOUNTS_DIR = "accounts"
ACCOUNT = "batch_id bigint, watermark string, valid bigint, accepted bigint, duplicates bigint, late bigint, late_windows bigint"
#: Name of the count of valid events that the stream observes before they are deduplicated.
VALID = "valid_events"


class RowAccounts(StreamingQueryListener):
    """Stores for every micro-batch how many valid events were accepted, duplicates or too late.

    Late events are those that the watermark drops at the deduplication, ``late_windows`` changes of
    windows dropped after it. The counts come with the progress of the query, so they cost no job
    but the writing of a row. ``first_id`` is added to batch ids, as in the other outputs.
    """

    def __init__(self, spark: SparkSession, base: str, query: str, first_id: int = 0):
        self.ledger, self.query, self.first_id = Ledger(spark, f"{base}/{ACCOUNTS_DIR}", ACCOUNT), query, first_id

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.query:
            return
        operators = progress.stateOperators
        first = next((o for o in operators if o.operatorName == "dedupe"), None)
        late_windows = sum(o.numRowsDroppedByWatermark for o in operators if o is not first)
        seen = progress.observedMetrics.get(VALID)
        row = (
            progress.batchId + self.first_id,
            progress.eventTime.get("watermark"),
            seen["n"] if seen else 0,
            first.numRowsUpdated if first else 0,
            first.customMetrics.get("numDroppedDuplicateRows", 0) if first else 0,
            first.numRowsDroppedByWatermark if first else 0,
            late_windows,
        )
        if any(row[2:]):
            self.ledger.put(self.query, row[0], progress.timestamp[:10], [row])

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_accounts(spark: SparkSession, base: str) -> DataFrame:
    """``ACCOUNT`` of every micro-batch that had valid events; of one run twice, one of the equal rows."""
    rows = spark.read.schema(f"{ACCOUNT}, date string, query string, slot string").parquet(f"{base}/{ACCOUNTS_DIR}")
    return rows.drop("date", "slot").dropDuplicates(["query", "batch_id"])
