"""Every operator as a named query over the tables of a data folder.

Input is the telemetry feed derived from the whole ``events`` table (``sources.feed``). Results
carry plain timestamps and averages rounded to six digits so that they can be compared with the
SQL of ``plans.checks``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from telemill.config import MEASURES, REQUIRED_FIELDS
from telemill.functions import numbers, text, times
from telemill.operators import analytics as an, changelog as cl, decode, dedup
from telemill.operators import normalize as no, rollups, validate as va, windows as wi
from telemill.plans import batch as plan
from telemill.schema import CHANGELOG, DEAD_LETTER, EVENT, WINDOW_COLUMNS
from telemill.sources import console_log, curated, feed, kafka, versions
from telemill.sources.scratch import scratch_dir
from telemill.streaming import job, metrics, stored_state

Query = Callable[[SparkSession, str], DataFrame]

WINDOW = "6 hours"
IDS = ("offset", "event_id", "batch_id")
ORIGIN = ("event_id", "offset")
AVERAGES = ("average_speed", "average_battery_level")

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, with results in comparable form."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


def _comparable(df: DataFrame) -> DataFrame:
    fixes: dict[str, Column] = {}
    for f in df.schema:
        if isinstance(f.dataType, TimestampType):
            fixes[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif f.name in AVERAGES:
            fixes[f.name] = numbers.round_to(F.col(f.name), 6)
    return df.withColumns(fixes) if fixes else df


def _no_nan(*names: str) -> dict[str, Column]:
    """NaN as null: it has no portable form in a result."""
    return {n: F.when(~F.isnan(n), F.col(n)) for n in names}


def _records(spark: SparkSession, d: str) -> DataFrame:
    return feed.read_feed(spark, d)


def _decoded(spark: SparkSession, d: str) -> DataFrame:
    return decode.decode_payload(_records(spark, d), IDS)


def _flagged(spark: SparkSession, d: str) -> DataFrame:
    return va.flag_events(_records(spark, d), carry=IDS)


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return va.valid_events(_flagged(spark, d), IDS)


def _judged(spark: SparkSession, d: str) -> DataFrame:
    return va.validate_rules(_records(spark, d), carry=IDS)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return va.text_events(_records(spark, d), IDS)


def _windows(spark: SparkSession, d: str, duration: str = WINDOW) -> DataFrame:
    return wi.batch_window_kpis(_valid(spark, d), "offset", duration)


def _changelog(spark: SparkSession, d: str) -> DataFrame:
    return plan.changelog(_records(spark, d), "offset", window_duration=WINDOW)


def _state(spark: SparkSession, d: str) -> DataFrame:
    return cl.latest_window_state(_changelog(spark, d))


# --- sources and sinks ---------------------------------------------------------------------


@query
def kafka_encode(spark, d):
    view = feed.telemetry_view(feed.events_table(spark, d)).select(*EVENT.fieldNames())
    sent = kafka.encode_messages(view)
    back = F.inline(F.array(F.from_json(F.col("value").cast("string"), EVENT)))
    return sent.select(F.col("key").cast("string").alias("message_key"), back).withColumns(_no_nan("temperature"))


@query
def raw_json_sink(spark, d):
    base = scratch_dir(spark, "raw")
    rows = _decoded(spark, d).select("json_payload", "kafka_timestamp", "batch_id")
    path = curated.write_raw(rows, base, F.col("batch_id"), "2024-02-01")
    schema = "json_payload string, kafka_timestamp timestamp, date string, batch_id bigint"
    return spark.read.schema(schema).json(path)


@query
def curated_parquet_sink(spark, d):
    base = scratch_dir(spark, "curated")
    curated.write_curated(_changelog(spark, d), base, F.col("batch_id"), "2024-02-01")
    return curated.read_curated(spark, base)


@query
def json_batch_sink(spark, d):
    base = scratch_dir(spark, "json")
    path = curated.write_json_batch(_state(spark, d), base, 0)
    return spark.read.schema(CHANGELOG).json(path)


@query
def curated_table(spark, d):
    base = scratch_dir(spark, "table")
    curated.write_curated(_changelog(spark, d), base, F.col("batch_id"), curated.event_date())
    database = "telemill_" + base.rsplit("-", 1)[-1].lower()
    name = curated.create_curated_table(spark, base, database)
    curated.repair_table(spark, name)
    return curated.show_partitions(spark, name)


@query
def curated_scan(spark, d):
    base = scratch_dir(spark, "scan")
    curated.write_curated(_changelog(spark, d), base, F.col("batch_id"), curated.event_date())
    return curated.read_curated(spark, base).select("vehicle_id", "window_start", "event_count", "date", "batch_id")


def _batches_written(spark: SparkSession, d: str, name: str) -> str:
    base = scratch_dir(spark, name)
    curated.write_curated(_changelog(spark, d), base, F.col("batch_id"), curated.event_date())
    return base


def _stored_versions(spark: SparkSession, d: str, name: str, last: int = 2) -> str:
    """Batches 0 and 1 as version 1, batch 2 as version 2 or, if ``last`` is 1, still pending."""
    base = _batches_written(spark, d, name)
    for batch in range(1, last + 1):
        versions.compact(spark, base, batch)
    return base


@query
def compacted_state(spark, d):
    base = _batches_written(spark, d, "compacted")
    versions.compact(spark, base, 0)
    versions.compact(spark, base, 1)
    return versions.read_compacted_state(spark, base)


@query
def compacted_late_run(spark, d):
    """A batch of an older run arrives after newer ones were compacted and their folders expired."""
    base, changes = scratch_dir(spark, "late-run"), _changelog(spark, d)
    newer = changes.filter("batch_id <> 1")
    curated.write_curated(newer, base, F.col("batch_id"), curated.event_date())
    versions.compact(spark, base)
    versions.expire(spark, base)
    curated.write_curated(changes.filter("batch_id = 1"), base, F.col("batch_id"), curated.event_date())
    versions.compact(spark, base)
    versions.expire(spark, base)
    return versions.read_compacted_state(spark, base)


@query
def version_diff(spark, d):
    base = _stored_versions(spark, d, "version-diff")
    return versions.version_diff(spark, base, 1, 2).select("vehicle_id", "window_start", "event_count", "change")


def _on_rollups(operator: Callable[[DataFrame], DataFrame], last: int) -> None:
    def build(spark, d):
        return operator(versions.read_rollups(spark, _stored_versions(spark, d, "rollups", last)))

    build.__name__ = f"rollup_{operator.__name__}"
    query(build)


for _operator in (
    rollups.vehicle_speed_summary,
    rollups.vehicle_max_temp,
    rollups.vehicle_fault_distribution,
    rollups.latest_window_per_vehicle,
    rollups.table_totals,
):
    _on_rollups(_operator, last=2)
_on_rollups(rollups.fleet_summary, last=1)


@query
def rollup_vehicle_battery_summary(spark, d):
    summary = rollups.vehicle_battery_summary(versions.read_rollups(spark, _stored_versions(spark, d, "rollups", 1)))
    return summary.withColumns({c: numbers.round_to(F.col(c), 6) for c in ("min_battery_pct", "max_battery_pct")})


def _on_newest(operator: Callable[[DataFrame], DataFrame], count: int, faults: bool = False, last: int = 2) -> None:
    def build(spark, d):
        base = _stored_versions(spark, d, "newest", last)
        return operator(versions.newest_windows(spark, base, count, faults))

    build.__name__ = f"newest_{operator.__name__}"
    query(build)


_on_newest(an.recent_window_metrics, 50)
_on_newest(an.latest_telemetry, 100)
_on_newest(an.latest_telemetry_desc, 100, last=1)
_on_newest(an.recent_faults, 50, faults=True)
_on_newest(an.top_faults, 10, faults=True, last=1)


@query
def newest_recent_windows(spark, d):
    base = _stored_versions(spark, d, "newest")
    end = versions.newest_end(spark, base)
    as_of = F.timestamp_micros(F.lit(None if end is None else round(end * 1e6)).cast("bigint"))
    return an.recent_windows(versions.windows_since(spark, base, (end or 0) - 1800), as_of=as_of)


@query
def changelog_text_scan(spark, d):
    base = scratch_dir(spark, "log")
    _write_console_logs(_changelog(spark, d), base)
    return console_log.latest_printed_state(spark, base)


def _write_console_logs(changes: DataFrame, path: str) -> None:
    """Print the changelog the way the console sink does, one log per vehicle and day.

    A task prints its logs one after the other; how many there are follows the data.
    """
    rows = changes.withColumn("log", F.xxhash64("vehicle_id", F.to_date("window_start")))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in WINDOW_COLUMNS]
    row = F.concat(F.lit("|"), F.concat_ws("|", *cells), F.lit("|"))
    body = rows.select("log", "batch_id", F.lit(1).alias("rank"), row.alias("value"))
    rule = F.lit("-" * 43)
    heading = F.concat_ws("\n", rule, F.concat(F.lit("Batch: "), "batch_id"), rule)
    heads = rows.select("log", "batch_id").distinct()
    heads = heads.select("log", "batch_id", F.lit(0).alias("rank"), heading.alias("value"))
    lines = heads.unionByName(body).repartition("log").sortWithinPartitions("log", "batch_id", "rank")
    lines.select("value").write.text(path)


@query
def table_append_sink(spark, d):
    base = scratch_dir(spark, "append")
    database = "telemill_" + base.rsplit("-", 1)[-1].lower()
    curated.create_database(spark, base, database)
    name = f"`{database}`.`aggregates`"
    curated.append_table(_state(spark, d), name)
    return spark.table(name)


@query
def table_append_replayed(spark, d):
    """Every micro-batch of the changelog appended, the second one twice."""
    base = scratch_dir(spark, "append-batch")
    database = "telemill_" + base.rsplit("-", 1)[-1].lower()
    curated.create_database(spark, base, database)
    name, changes = f"`{database}`.`aggregates`", _changelog(spark, d)
    for batch in (0, 1, 1, 2):
        curated.append_batch(cl.batch_filter(changes, batch), name, batch)
    return spark.table(name)


@query
def metrics_by_batch(spark, d):
    return metrics.metrics_by_batch(_flagged(spark, d), _changelog(spark, d))


# --- projections and scalar functions ------------------------------------------------------


@query
def decode_payload(spark, d):
    return _decoded(spark, d).select("event_id", "offset", "json_payload", "kafka_timestamp")


@query
def parse_json(spark, d):
    parsed = decode.parse_json(_decoded(spark, d)).select(*ORIGIN, F.inline(F.array("event")))
    return parsed.withColumns(_no_nan("temperature"))


@query
def flatten_event(spark, d):
    return decode.flatten_event(_decoded(spark, d)).drop("batch_id").withColumns(_no_nan("temperature"))


@query
def normalize_vehicle_id(spark, d):
    return _texts(spark, d).select(
        *ORIGIN,
        text.vehicle_id(F.col("vehicle_id")).alias("vehicle_id"),
        text.vehicle_id(F.col("vehicle_id"), lenient=True).alias("vehicle_id_lenient"),
    )


@query
def normalize_fault_code(spark, d):
    return _texts(spark, d).select(
        *ORIGIN,
        text.fault_code(F.col("fault_code")).alias("fault_code"),
        text.fault_code_alias(F.col("fault_code")).alias("fault_code_alias"),
    )


@query
def parse_event_time(spark, d):
    return _texts(spark, d).select(
        *ORIGIN,
        times.event_time(F.col("timestamp")).alias("event_timestamp"),
        times.iso_canonical(F.col("timestamp")).alias("iso_timestamp"),
    )


@query
def coerce_numeric(spark, d):
    objects = _texts(spark, d).filter(~F.col("is_malformed"))
    return objects.select(*ORIGIN, *[no.coerce_numeric(m).alias(m) for m in MEASURES]).withColumns(_no_nan("temperature"))


@query
def normalize_events(spark, d):
    return no.normalize_events(_records(spark, d), carry=ORIGIN).withColumns(_no_nan("temperature"))


@query
def light_trim(spark, d):
    return va.light_trim(_texts(spark, d)).select(*ORIGIN, "vehicle_id", "fault_code")


@query
def typed_projection(spark, d):
    """The state as an all-text result with holes and unreadable cells."""
    s = _state(spark, d)
    speed, battery = (numbers.round_2(F.col(c)).cast("string") for c in AVERAGES)
    rows = s.select(
        F.when(F.col("event_count") % 7 != 0, F.col("vehicle_id")).alias("vehicle_id"),
        times.as_text(F.col("window_start")).alias("window_start"),
        F.when(F.col("fault_count") > 0, times.as_text(F.col("window_end"))).alias("window_end"),
        F.when(F.col("event_count") % 5 != 0, speed).alias("average_speed"),
        F.when(F.col("fault_count") % 4 == 3, "n/a").otherwise(battery).alias("average_battery_level"),
        F.col("maximum_temperature").cast("string").alias("maximum_temperature"),
        F.concat(F.col("fault_count").cast("string"), F.lit(".7")).alias("fault_count"),
        F.when(F.col("event_count") % 6 == 0, "").otherwise(F.col("event_count").cast("string")).alias("event_count"),
    )
    return an.typed_projection(rows)


@query
def flatten_window(spark, d):
    return _windows(spark, d, "1 hour").select("vehicle_id", "window_start", "window_end", "event_count")


@query
def round_2(spark, d):
    return _state(spark, d).select(
        "vehicle_id",
        "window_start",
        numbers.round_2(F.col("average_speed")).alias("speed_2dp"),
        numbers.round_2(F.col("average_battery_level")).alias("battery_2dp"),
        numbers.round_2(F.col("maximum_temperature")).alias("temperature_2dp"),
    )


@query
def timestamp_to_string(spark, d):
    return _state(spark, d).select(
        "vehicle_id",
        times.as_text(F.col("window_start")).alias("window_start"),
        times.as_text(F.col("window_end")).alias("window_end"),
    )


@query
def fault_rate_pct(spark, d):
    return _state(spark, d).select(
        "vehicle_id",
        "window_start",
        numbers.fault_rate_pct(F.col("fault_count"), F.col("event_count"), 1).alias("rate_1dp"),
        numbers.fault_rate_pct(F.col("fault_count"), F.col("event_count"), 2).alias("rate_2dp"),
        numbers.fault_rate_pct(F.col("event_count"), F.col("fault_count"), 2).alias("inverse_rate"),
    )


@query
def window_status(spark, d):
    return an.window_status(_state(spark, d)).select(
        "vehicle_id", "window_start", "fault_count", "status", "status_label"
    )


@query
def validation_errors(spark, d):
    return _judged(spark, d).select(*ORIGIN, F.array_join("errors", "; ").alias("errors"))


# --- filters and routing -------------------------------------------------------------------


@query
def malformed_split(spark, d):
    return va.malformed_events(_flagged(spark, d), ORIGIN)


@query
def valid_events(spark, d):
    return _valid(spark, d).drop("batch_id")


@query
def invalid_events(spark, d):
    return va.invalid_events(_flagged(spark, d), ORIGIN)


@query
def validate_rules(spark, d):
    return _judged(spark, d).select(*ORIGIN, "valid", F.size("errors").alias("error_count"))


@query
def validate_split(spark, d):
    return va.split_rows(_judged(spark, d), ORIGIN)


@query
def missing_fields(spark, d):
    objects = _texts(spark, d).filter(~F.col("is_malformed"))
    return objects.select(*ORIGIN, F.explode(va.missing_fields()).alias("field"))


@query
def fault_windows(spark, d):
    return an.fault_windows(_state(spark, d))


@query
def high_temp_windows(spark, d):
    return an.high_temp_windows(_state(spark, d))


@query
def recent_windows(spark, d):
    # copies of an event do not move the newest window, so the events as they come will do
    newest = _valid(spark, d).select(F.max(F.window("event_timestamp", WINDOW)["end"])).scalar()
    return an.recent_windows(_state(spark, d), as_of=newest)


@query
def batch_filter(spark, d):
    return cl.batch_filter(_state(spark, d), 1)


# --- deduplication -------------------------------------------------------------------------


@query
def stream_dedup(spark, d):
    first = dedup.first_arrival(_valid(spark, d), ["offset"])
    return first.select(*ORIGIN, "vehicle_id", "event_timestamp", "speed", "fault_code")


@query
def exact_dedup(spark, d):
    distinct = dedup.exact_dedup_payloads(_decoded(spark, d))
    return distinct.select(
        *[F.try_element_at("fields", F.lit(f)).alias(f) for f in REQUIRED_FIELDS], F.size("fields").alias("key_count")
    )


# --- windows -------------------------------------------------------------------------------


@query
def window_kpis(spark, d):
    return _windows(spark, d)


@query
def window_kpis_5m(spark, d):
    return _windows(spark, d, "5 minutes")


@query
def window_kpis_rounded(spark, d):
    return plan.rule_checked_summaries(_records(spark, d), 21_600)


@query
def fault_count_expr(spark, d):
    events = _texts(spark, d).withColumn("code", text.fault_code(F.col("fault_code")))
    return events.groupBy("batch_id").agg(
        F.sum(wi.is_fault("code")).alias("faults"), F.sum(wi.is_fault_any_case()).alias("faults_any_case")
    )


@query
def sorted_windows(spark, d):
    return wi.sorted_windows(_windows(spark, d, "1 day"))


# --- analytics -----------------------------------------------------------------------------


def _on_state(name: str, operator: Callable[[DataFrame], DataFrame]) -> None:
    def build(spark, d):
        return operator(_state(spark, d))

    build.__name__ = name
    query(build)


for _operator in (
    an.vehicle_speed_summary,
    an.vehicle_max_temp,
    an.vehicle_fault_distribution,
    an.latest_window_per_vehicle,
    an.table_totals,
    an.fleet_summary,
    an.fault_kpis,
    an.fault_vehicles,
    an.recent_window_metrics,
    an.latest_telemetry,
    an.recent_faults,
    an.latest_telemetry_desc,
    cl.batch_counts,
):
    _on_state(_operator.__name__, _operator)

_on_state("top10_faults", an.top_faults)
_on_state("latest_window_state", lambda state: state)


@query
def vehicle_battery_summary(spark, d):
    summary = an.vehicle_battery_summary(_state(spark, d))
    return summary.withColumns({c: numbers.round_to(F.col(c), 6) for c in ("min_battery_pct", "max_battery_pct")})


@query
def sort_by_column(spark, d):
    return an.sort_by_column(_state(spark, d), "average_speed", descending=False)


@query
def invalid_counts(spark, d):
    return va.invalid_counts(_flagged(spark, d))


@query
def dq_reason_counts(spark, d):
    return va.dq_reason_counts(_judged(spark, d))


@query
def dead_letter(spark, d):
    return va.dead_letter(_flagged(spark, d), ORIGIN)


@query
def snapshot_diff(spark, d):
    changes = _changelog(spark, d)
    before = cl.latest_window_state(changes.filter("batch_id <= 1"))
    diff = cl.snapshot_diff(cl.latest_window_state(changes), before)
    return diff.select("vehicle_id", "window_start", "event_count", "change")


@query
def ingest_outcomes(spark, d):
    outcome = F.coalesce("error_reason", F.lit("valid")).alias("outcome")
    return _flagged(spark, d).groupBy("batch_id", outcome).agg(F.count(F.lit(1)).alias("records"))


# --- the same over keys that grow with the table -------------------------------------------


def _wide_valid(spark: SparkSession, d: str) -> DataFrame:
    return va.valid_events(va.flag_events(feed.read_feed(spark, d, wide=True), carry=IDS), IDS)


def _wide_changelog(spark: SparkSession, d: str) -> DataFrame:
    return plan.changelog(feed.read_feed(spark, d, wide=True), "offset", window_duration=WINDOW)


@query
def window_kpis_wide(spark, d):
    return wi.batch_window_kpis(_wide_valid(spark, d), "offset", WINDOW)


@query
def stream_dedup_wide(spark, d):
    first = dedup.first_arrival(_wide_valid(spark, d), ["offset"])
    return first.select(*ORIGIN, "vehicle_id", "event_timestamp", "speed", "fault_code")


@query
def latest_window_state_wide(spark, d):
    return cl.latest_window_state(_wide_changelog(spark, d))


@query
def vehicle_speed_summary_wide(spark, d):
    return an.vehicle_speed_summary(cl.latest_window_state(_wide_changelog(spark, d)))


@query
def fleet_summary_wide(spark, d):
    return an.fleet_summary(cl.latest_window_state(_wide_changelog(spark, d)))


@query
def invalid_counts_wide(spark, d):
    return va.invalid_counts(va.flag_events(feed.read_feed(spark, d, wide=True), carry=IDS))


@query
def new_window_count(spark, d):
    changes = _changelog(spark, d)
    before = cl.latest_window_state(changes.filter("batch_id <= 1"))
    return cl.new_window_count(cl.snapshot_diff(cl.latest_window_state(changes), before))


@query
def curated_scan_dates(spark, d):
    base = scratch_dir(spark, "scan-dates")
    curated.write_curated(_changelog(spark, d), base, F.col("batch_id"), curated.event_date())
    rows = curated.read_curated(spark, base, ("2024-01-03", "2024-01-10"))
    return rows.select("vehicle_id", "window_start", "event_count", "date", "batch_id")


# --- streaming -----------------------------------------------------------------------------


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """The feed as a stream over the same table."""
    # A pattern, because a plain path would have to be a folder; it matches this name only.
    events = spark.readStream.schema(feed.EVENTS).parquet(f"{d}/events.parque[t]")
    return feed.kafka_records(feed.telemetry_view(events))


def _settings(spark: SparkSession, name: str) -> job.JobSettings:
    base = scratch_dir(spark, name)
    return job.JobSettings(f"{base}/checkpoint", f"{base}/out", WINDOW, "2 minutes", emit_metrics=False)


@query
def stream_window_state(spark, d):
    settings = _settings(spark, "stream-windows")
    job.start_aggregates(_stream(spark, d), settings, {"availableNow": True}).awaitTermination()
    return curated.read_state(spark, settings.output).drop("batch_id")


@query
def stream_window_state_batches(spark, d):
    """Run by run over one checkpoint, the copies of an event in different micro-batches.

    A run takes all files of its part at once: there are as many micro-batches at any size.
    """
    settings, records = replace(_settings(spark, "stream-batches"), watermark_delay="40 days"), _records(spark, d)
    start = lambda stream: job.start_aggregates(stream, settings, {"availableNow": True})
    _runs_over(spark, [records.filter(F.col("offset") % 3 == part) for part in range(3)], start, scratch_dir(spark, "stream-files"))
    return curated.read_state(spark, settings.output).drop("batch_id")


@query
def stream_dead_letter(spark, d):
    settings = _settings(spark, "stream-route")
    job.start_route(_stream(spark, d), settings, {"availableNow": True}).awaitTermination()
    path = f"{settings.output}/{curated.DEAD_LETTER_DIR}"
    return spark.read.schema(DEAD_LETTER).parquet(path).select(*DEAD_LETTER.fieldNames())


@query
def stream_final_windows(spark, d):
    settings = _settings(spark, "stream-final")
    job.start_final_windows(_stream(spark, d), settings, {"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{settings.output}/final_windows").withColumn("date", F.col("date").cast("string"))


def _runs_over(spark: SparkSession, parts: list[DataFrame], start: Callable[[DataFrame], StreamingQuery], folder: str) -> None:
    """One run to the end for each part, all over one growing folder and one checkpoint."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        start(spark.readStream.schema(part.schema).parquet(folder)).awaitTermination()


@query
def stream_first_arrival(spark, d):
    """Copies of an event arrive in any order; the one with the least offset is the event.

    The last run brings one event far ahead, which moves the watermark past all others.
    """
    settings, records = replace(_settings(spark, "stream-first"), watermark_delay="40 days"), _records(spark, d)
    later = F.max(F.expr("kafka_timestamp + INTERVAL 100 DAYS"))
    ahead = feed.telemetry_view(feed.events_table(spark, d)).agg(later.alias("kafka_timestamp"))
    stamp = F.date_format("kafka_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.format_string('{"vehicle_id": "BMW-LAST", "timestamp": "%s", "speed": 1, "battery_level": 1, "temperature": 1, "fault_code": "NONE"}', stamp)
    closing = ahead.select(
        F.lit("BMW-LAST").cast("binary").alias("key"), body.cast("binary").alias("value"), F.col("kafka_timestamp").alias("timestamp"),
        *[F.lit(-1).cast("bigint").alias(c) for c in ("offset", "event_id")], F.lit(-1).cast(records.schema["batch_id"].dataType).alias("batch_id"),
    )
    parts = [records.filter(F.col("offset") % 3 == 2 - i) for i in range(3)] + [closing]

    def start(stream: DataFrame) -> StreamingQuery:
        valid = va.valid_events(va.flag_events(stream, settings.rules, carry=IDS), IDS)
        first = dedup.first_arrival_stream(valid, settings.watermark_delay, "offset")
        writer = first.writeStream.format("parquet").option("path", f"{settings.output}/events")
        return writer.option("checkpointLocation", settings.checkpoint).trigger(availableNow=True).start()

    _runs_over(spark, parts, start, scratch_dir(spark, "stream-first-files"))
    return spark.read.parquet(f"{settings.output}/events").select(*ORIGIN, "vehicle_id", "event_timestamp", "speed", "fault_code")


@query
def stream_late_rows(spark, d):
    """What became of every valid event of four runs under a watermark of three days."""
    settings, records = replace(_settings(spark, "stream-late"), watermark_delay="3 days"), _records(spark, d)
    # most records come in the order of their weeks, some a run or two late
    week = F.floor(F.unix_seconds("timestamp") / 604_800)
    part = F.pmod(week + F.col("event_id") % 3, F.lit(4))
    folder = scratch_dir(spark, "stream-late-files")
    accounts = metrics.RowAccounts(spark, settings.output, "aggregates")
    spark.streams.addListener(accounts)
    try:
        start = lambda stream: job.start_aggregates(stream, settings, {"availableNow": True})
        _runs_over(spark, [records.filter(part == i) for i in range(4)], start, folder)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(accounts)
    found = metrics.read_accounts(spark, settings.output)
    return found.select(F.dense_rank().over(Window.orderBy("batch_id")).alias("run"), "valid", "accepted", "duplicates", "late")


@query
def stream_stored_state(spark, d):
    """The windows that a query keeps in its checkpoint after two runs."""
    settings, records = replace(_settings(spark, "stream-state"), watermark_delay="40 days"), _records(spark, d)
    start = lambda stream: job.start_aggregates(stream, settings, {"availableNow": True})
    _runs_over(spark, [records.filter(F.col("offset") % 3 < 2), records.filter(F.col("offset") % 3 == 2)], start, scratch_dir(spark, "stream-state-files"))
    return stored_state.stored_windows(spark, f"{settings.checkpoint}/aggregates")
