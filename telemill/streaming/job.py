"""The continuous job: two queries over one kind of source frame.

``route``       every record once: raw copy, dead letters, input counters (stateless)
``aggregates``  watermark, dedup, windows in update mode; each micro-batch goes to the curated
                table, the counters and, if wanted, the console

A failing sink fails its query, so a batch is never committed without its output.
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from telemill.config import DEFAULT_RULES, DEFAULT_WATERMARK, DEFAULT_WINDOW, RuleSet
from telemill.operators.dedup import first_arrival_stream, stream_dedup
from telemill.operators.validate import dead_letter, flag_events, valid_events
from telemill.operators.windows import window_kpis
from telemill.sources import curated
from telemill.sources.kafka import read_kafka_events
from telemill.streaming import metrics

logger = logging.getLogger(__name__)

# State on local disk with incremental uploads: heap use stays flat as the key count grows.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class JobSettings:
    checkpoint: str
    output: str
    window_duration: str = DEFAULT_WINDOW
    watermark_delay: str = DEFAULT_WATERMARK
    bootstrap_servers: str = "localhost:9092"
    topic: str = "telemetry-events"
    console: bool = False
    emit_metrics: bool = True
    rules: RuleSet = DEFAULT_RULES
    dedup_salts: int = 1
    output_files: int = 8
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    fail_on_data_loss: bool = False
    trigger: str | None = None

    def source_options(self) -> dict[str, str]:
        """Rate, parallelism and loss options of the broker source."""
        given = {"maxOffsetsPerTrigger": self.max_offsets_per_trigger, "minPartitions": self.min_partitions}
        options = {k: str(v) for k, v in given.items() if v is not None}
        return options | {"failOnDataLoss": str(self.fail_on_data_loss).lower()}

    def trigger_options(self) -> dict | None:
        """``available-now`` handles what is there; anything else is the time between batches."""
        if self.trigger is None:
            return None
        return {"availableNow": True} if self.trigger == "available-now" else {"processingTime": self.trigger}


#: Batch ids a run has to itself.
RUN_BATCHES = 1 << 40


def _runs(spark: SparkSession, path: str) -> list[int]:
    try:
        return [r.run for r in spark.read.schema("run bigint").parquet(path).collect()]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []


def first_batch_id(spark: SparkSession, settings: JobSettings) -> int:
    """What a run adds to its batch ids, so that a fresh checkpoint never overwrites earlier output.

    Runs into one output are numbered in order, a number stays with its checkpoint, and later runs
    have larger ids, which makes their window states win.
    """
    mark, ledger = f"{settings.checkpoint}/run", f"{settings.output}/runs"
    if known := _runs(spark, mark):
        return known[0] * RUN_BATCHES
    number = max(_runs(spark, ledger), default=-1) + 1
    row = spark.range(number, number + 1).withColumnRenamed("id", "run").coalesce(1)
    row.write.mode("append").parquet(ledger)
    row.write.mode("overwrite").parquet(mark)
    return number * RUN_BATCHES


def parse_args(argv: Sequence[str] | None = None) -> JobSettings:
    """Settings from arguments, with defaults from the environment."""
    env = os.environ.get
    parser = argparse.ArgumentParser(description="Run the continuous telemetry job.")
    parser.add_argument("--bootstrap-servers", default=env("KAFKA_BOOTSTRAP_SERVERS", JobSettings.bootstrap_servers))
    parser.add_argument("--topic", default=env("KAFKA_TOPIC", JobSettings.topic))
    parser.add_argument("--window-duration", default=env("SPARK_WINDOW_DURATION", DEFAULT_WINDOW))
    parser.add_argument("--watermark-delay", default=env("SPARK_WATERMARK_DELAY", DEFAULT_WATERMARK))
    parser.add_argument("--checkpoint", default=env("SPARK_CHECKPOINT_LOCATION", "./checkpoints/telemetry"))
    parser.add_argument("--output", required=True, help="base folder of all outputs")
    parser.add_argument("--dedup-salts", type=int, default=1, help="split copies of one event over this many tasks")
    parser.add_argument("--output-files", type=int, default=8, help="tasks that write one batch of windows")
    parser.add_argument("--starting-offsets", default=JobSettings.starting_offsets, help="of a first run")
    parser.add_argument("--max-offsets-per-trigger", type=int, help="records of one micro-batch at most")
    parser.add_argument("--min-partitions", type=int, help="split the topic's partitions over so many tasks")
    parser.add_argument("--fail-on-data-loss", action="store_true", help="stop when offsets have expired")
    parser.add_argument("--trigger", help="'available-now', or the time between batches such as '10 seconds'")
    parser.add_argument("--console", action="store_true", help="also print every aggregate batch")
    args = parser.parse_args(argv)
    return JobSettings(**vars(args))


# --- frames --------------------------------------------------------------------------------


def parse_and_validate_events(
    records: DataFrame,
    watermark_delay: str = DEFAULT_WATERMARK,
    rules: RuleSet = DEFAULT_RULES,
    dedup_salts: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """``(valid, watermarked and deduplicated events, dead letters)`` of a broker stream."""
    flagged = flag_events(records, rules)
    valid = valid_events(flagged).observe(metrics.VALID, F.count(F.lit(1)).alias("n"))
    return stream_dedup(valid, watermark_delay, salts=dedup_salts), dead_letter(flagged)


def build_frames(
    records: DataFrame,
    window_duration: str = DEFAULT_WINDOW,
    watermark_delay: str = DEFAULT_WATERMARK,
    rules: RuleSet = DEFAULT_RULES,
    dedup_salts: int = 1,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid events, dead letters, window aggregates)`` over any broker-shaped frame."""
    valid, rejected = parse_and_validate_events(records, watermark_delay, rules, dedup_salts)
    return valid, rejected, window_kpis(valid, window_duration)


# --- micro-batch callbacks -----------------------------------------------------------------


def _cached(work: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several outputs from one computation of the micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            work(batch, batch_id)
        finally:
            batch.unpersist()

    return run


def route_batch(settings: JobSettings, first_id: int = 0) -> Callable[[DataFrame, int], None]:
    """Raw copy, dead letters and input counters of one micro-batch of flagged records."""

    ledger: list[metrics.Ledger] = []

    def work(batch: DataFrame, batch_id: int) -> None:
        batch_id += first_id
        date, counts = curated.arrival_date(), Observation()
        # the counters come with the pass that writes the raw copy
        counted = batch.observe(
            counts,
            F.count(F.lit(1)).alias("received"),
            F.count_if(~F.col("is_valid")).alias("rejected"),
            F.max(date).alias("date"),
        )
        curated.write_raw(counted.select("json_payload", "kafka_timestamp"), settings.output, batch_id, date)
        curated.write_dead_letter(dead_letter(batch), settings.output, batch_id, date)
        received, rejected = counts.get.get("received", 0), counts.get.get("rejected", 0)
        if rejected:
            logger.warning("batch %d: %d invalid records", batch_id, rejected)
        if settings.emit_metrics:
            metrics.emit_batch_metrics(
                batch.sparkSession,
                settings.output,
                "route",
                batch_id,
                counts.get.get("date"),
                _ledger(ledger, batch.sparkSession, settings),
                records_processed=received,
                invalid_records=rejected,
            )

    return _cached(work)


def _ledger(held: list[metrics.Ledger], spark: SparkSession, settings: JobSettings) -> metrics.Ledger:
    """The query's ledger of counters, made in its first micro-batch."""
    if not held:
        held.append(metrics.Ledger(spark, f"{settings.output}/{metrics.METRICS_DIR}"))
    return held[0]


def aggregate_batch(settings: JobSettings, first_id: int = 0) -> Callable[[DataFrame, int], None]:
    """Curated rows, counters and console print of one micro-batch of window aggregates.

    At most ``output_files`` tasks write, however many partitions the state has. The counters come with
    the pass that writes; the batch is kept only if it is also printed.
    """
    ledger: list[metrics.Ledger] = []

    def work(batch: DataFrame, batch_id: int) -> None:
        batch_id += first_id
        counts = Observation()
        counted = batch.observe(counts, F.count(F.lit(1)).alias("rows"), F.max(curated.event_date()).alias("date"))
        curated.write_curated(counted.coalesce(settings.output_files), settings.output, batch_id, curated.event_date())
        if settings.console:
            print(f"{'-' * 43}\nBatch: {batch_id}\n{'-' * 43}")
            batch.show(truncate=False)
        if settings.emit_metrics:
            metrics.emit_batch_metrics(
                batch.sparkSession,
                settings.output,
                "aggregates",
                batch_id,
                counts.get.get("date"),
                _ledger(ledger, batch.sparkSession, settings),
                batches_processed=1,
                aggregated_records=counts.get.get("rows", 0),
            )

    return _cached(work) if settings.console else work


# --- queries -------------------------------------------------------------------------------


def _writer(frame: DataFrame, mode: str, checkpoint: str, name: str, trigger: dict | None):
    writer = frame.writeStream.outputMode(mode).queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    return writer.trigger(**trigger) if trigger else writer


def _windows(records: DataFrame, settings: JobSettings) -> DataFrame:
    s = settings
    return build_frames(records, s.window_duration, s.watermark_delay, s.rules, s.dedup_salts)[2]


def start_route(records: DataFrame, settings: JobSettings, trigger: dict | None = None) -> StreamingQuery:
    flagged = flag_events(records, settings.rules)
    work = route_batch(settings, first_batch_id(records.sparkSession, settings))
    return _writer(flagged, "append", settings.checkpoint, "route", trigger).foreachBatch(work).start()


def start_aggregates(records: DataFrame, settings: JobSettings, trigger: dict | None = None) -> StreamingQuery:
    """Update mode: a window is written again whenever it changes."""
    windows = _windows(records, settings)
    work = aggregate_batch(settings, first_batch_id(records.sparkSession, settings))
    return _writer(windows, "update", settings.checkpoint, "aggregates", trigger).foreachBatch(work).start()


def first_arrivals(records: DataFrame, settings: JobSettings, arrival: str) -> DataFrame:
    """Valid events of a stream, of each the row with the least ``arrival``, once the watermark has passed it."""
    valid = valid_events(flag_events(records, settings.rules, carry=[arrival]), [arrival])
    valid = valid.observe(metrics.VALID, F.count(F.lit(1)).alias("n"))
    return first_arrival_stream(valid, settings.watermark_delay, arrival)


def start_final_windows(
    records: DataFrame, settings: JobSettings, trigger: dict | None = None, arrival: str | None = None
) -> StreamingQuery:
    """Append mode: every window once, when the watermark has passed it (exactly-once file sink).

    ``arrival`` names a column of the records that orders arrivals (the broker's offset): of the copies
    of an event that with the least one counts, in whatever order they are read. Without it, that which
    is read first counts. A bounded run ends with the windows above the watermark still open; they are
    not written.
    """
    if arrival is None:
        windows = _windows(records, settings)
    else:
        windows = window_kpis(first_arrivals(records, settings, arrival), settings.window_duration)
    dated = windows.withColumn("date", curated.event_date())
    return (
        _writer(dated, "append", settings.checkpoint, "final_windows", trigger)
        .partitionBy("date")
        .format("parquet")
        .option("path", f"{settings.output}/final_windows")
        .start()
    )


def start_console(windows: DataFrame, checkpoint: str, trigger: dict | None = None, rows: int = 20) -> StreamingQuery:
    """Aggregates on the console, untruncated."""
    return (
        _writer(windows, "update", checkpoint, "console", trigger)
        .format("console")
        .option("truncate", "false")
        .option("numRows", str(rows))
        .start()
    )


def run(
    spark: SparkSession,
    settings: JobSettings,
    records: DataFrame | None = None,
    trigger: dict | None = None,
) -> None:
    """Start both queries and wait; the first failure stops the other and is raised.

    With ``trigger={"availableNow": True}`` the job handles what is there and returns.
    """
    if records is None:
        records = read_kafka_events(
            spark,
            settings.bootstrap_servers,
            settings.topic,
            starting_offsets=settings.starting_offsets,
            extra=settings.source_options(),
        )
    trigger = trigger or settings.trigger_options()
    if settings.emit_metrics:
        metrics.emit_status(spark, settings.output, running=True)
    queries: list[StreamingQuery] = []
    accounts = metrics.RowAccounts(spark, settings.output, "aggregates", first_batch_id(spark, settings))
    if settings.emit_metrics:
        spark.streams.addListener(accounts)
    try:
        # before the first start: a query that fails while the next one starts must not be forgotten
        spark.streams.resetTerminated()
        for start in (start_route, start_aggregates):
            queries.append(start(records, settings, trigger))
        bounded = trigger is not None and ("availableNow" in trigger or "once" in trigger)
        if bounded:
            for query in queries:
                query.awaitTermination()
        else:
            spark.streams.awaitAnyTermination()
            for query in queries:
                if query.exception():
                    raise query.exception()
    except KeyboardInterrupt:
        logger.info("interrupted, stopping")
    except Exception:
        if settings.emit_metrics:
            metrics.emit_error(spark, settings.output)
        raise
    finally:
        for query in queries:
            query.stop()
        if settings.emit_metrics:
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            spark.streams.removeListener(accounts)
            metrics.emit_status(spark, settings.output, running=False)


def main(argv: Sequence[str] | None = None) -> None:
    settings = parse_args(argv)
    builder = SparkSession.builder.appName("telemetry").config("spark.sql.session.timeZone", "UTC")
    for key, value in STATE_STORE_CONF.items():
        builder = builder.config(key, value)
    run(builder.getOrCreate(), settings)


if __name__ == "__main__":
    main()
