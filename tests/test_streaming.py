import datetime as dt
import json
import os
import time

import pytest
from conftest import event
from pyspark.sql import functions as F

from telemill.operators import analytics as an, changelog as cl, validate as va
from telemill.schema import KAFKA_RECORD, WINDOW_COLUMNS
from telemill.sources import console_log, curated
from telemill.streaming import job, metrics

NOW = {"availableNow": True}


class Script:
    """Broker records arriving file by file; each file is one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.count = spark, folder / "in", 0
        self.folder.mkdir()

    def arrive(self, *payloads):
        arrived = dt.datetime(2026, 9, 17, 12, tzinfo=dt.timezone.utc)
        rows = [
            (b"k", (p if isinstance(p, str) else json.dumps(p)).encode(), arrived + dt.timedelta(seconds=i))
            for i, p in enumerate(payloads)
        ]
        self.count += 1
        # One file, written elsewhere and moved in, with a modification time that fixes the order.
        stage = self.folder.parent / f"stage{self.count}"
        self.spark.createDataFrame(rows, KAFKA_RECORD).coalesce(1).write.parquet(str(stage))
        (part,) = stage.glob("part-*.parquet")
        os.utime(part, (1_700_000_000 + self.count, 1_700_000_000 + self.count))
        part.rename(self.folder / f"{self.count:03d}.parquet")

    def stream(self):
        reader = self.spark.readStream.schema(KAFKA_RECORD).option("maxFilesPerTrigger", 1)
        return reader.parquet(str(self.folder))


@pytest.fixture
def script(spark, tmp_path):
    return Script(spark, tmp_path)


@pytest.fixture
def settings(tmp_path):
    return job.JobSettings(str(tmp_path / "checkpoint"), str(tmp_path / "out"), "5 minutes", "2 minutes")


@pytest.fixture
def rocksdb(spark):
    for key, value in job.STATE_STORE_CONF.items():
        spark.conf.set(key, value)
    yield
    for key in job.STATE_STORE_CONF:
        spark.conf.unset(key)


def at(clock, speed=50.0, vehicle="BMW-1", **more):
    return event(vehicle_id=vehicle, timestamp=f"2026-09-17T{clock}Z", speed=speed, **more)


def run_aggregates(script, settings):
    query = job.start_aggregates(script.stream(), settings, NOW)
    query.awaitTermination()
    return query


def state(spark, settings):
    rows = curated.read_state(spark, settings.output).collect()
    return {(r.vehicle_id, r.window_start.strftime("%H:%M")): (r.event_count, r.average_speed) for r in rows}


def dropped_late(query):
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p["stateOperators"])


def test_updates_duplicates_and_late_rows(spark, script, settings):
    script.arrive(at("10:00:00", 10), at("10:00:00", 99), at("10:01:00", 20))
    script.arrive(at("10:01:00", 77), at("10:02:00", 60))  # first one seen before
    script.arrive(at("10:20:00", 5))  # moves the watermark to 10:18
    script.arrive(at("10:20:30", 5))
    script.arrive(at("10:04:00", 500 / 2), at("10:21:00", 5))  # 10:04 is too late
    query = run_aggregates(script, settings)
    assert state(spark, settings) == {("BMW-1", "10:00"): (3, 30.0), ("BMW-1", "10:20"): (3, 5.0)}
    assert dropped_late(query) == 1
    changes = curated.read_curated(spark, settings.output)
    history = [r.event_count for r in changes.filter("hour(window_start) = 10 AND minute(window_start) = 0").orderBy("batch_id").collect()]
    assert history == [2, 3], "a window is written each time it changes, and only then"


def test_salted_dedup_gives_the_same_windows(spark, script, settings):
    script.arrive(*[at("10:00:00", 10)] * 50, at("10:01:00", 20))
    script.arrive(*[at("10:00:00", 10)] * 50, at("10:02:00", 60))
    salted = job.JobSettings(**{**vars(settings), "dedup_salts": 8})
    run_aggregates(script, salted)
    assert state(spark, settings) == {("BMW-1", "10:00"): (3, 30.0)}


def test_restart_continues_from_the_checkpoint(spark, script, settings, rocksdb):
    script.arrive(at("10:00:00", 10))
    run_aggregates(script, settings)
    script.arrive(at("10:00:00", 90), at("10:01:00", 30))
    run_aggregates(script, settings)
    assert state(spark, settings) == {("BMW-1", "10:00"): (2, 20.0)}
    run_aggregates(script, settings)  # nothing new
    assert curated.read_curated(spark, settings.output).count() == 2


def test_replayed_batch_leaves_one_copy(spark, settings):
    row = ("BMW-1", dt.datetime(2026, 9, 17, 10), dt.datetime(2026, 9, 17, 10, 5), 1.0, 1.0, 1.0, 0, 1)
    batch = spark.createDataFrame([row], "vehicle_id string, window_start timestamp, window_end timestamp, average_speed double, average_battery_level double, maximum_temperature double, fault_count bigint, event_count bigint")
    for _ in range(2):
        job.aggregate_batch(settings)(batch, 4)
    assert curated.read_curated(spark, settings.output).count() == 1
    assert metrics.read_metrics(spark, settings.output).count() == 5


def test_append_mode_emits_each_final_window_once(spark, script, settings):
    script.arrive(at("10:00:00", 10))
    script.arrive(at("10:01:00", 30), at("10:06:00", 1))
    script.arrive(at("10:30:00"))
    script.arrive(at("10:31:00"))
    job.start_final_windows(script.stream(), settings, NOW).awaitTermination()
    rows = spark.read.parquet(f"{settings.output}/final_windows").orderBy("window_start").collect()
    assert [(r.window_start.minute, r.event_count, r.average_speed) for r in rows] == [(0, 2, 20.0), (5, 1, 1.0)]


def test_whole_job(spark, script, settings, capsys):
    script.arrive(at("10:00:00"), at("10:00:00"), "not json", at("10:01:00", -1))
    script.arrive(at("10:02:00", fault_code="temp-high"), at("10:03:00", vehicle="BMW-2"), "{}")
    job.run(spark, job.JobSettings(**{**vars(settings), "console": True}), script.stream(), NOW)

    dead = spark.read.parquet(f"{settings.output}/{curated.DEAD_LETTER_DIR}")
    reasons = {r.error_reason: r["count"] for r in dead.groupBy("error_reason").count().collect()}
    assert reasons == {"malformed_json": 1, "invalid_telemetry_values": 2}
    raw = spark.read.json(f"{settings.output}/{curated.RAW_DIR}")
    assert raw.count() == 7 and "not json" in {r.json_payload for r in raw.collect()}

    summary = an.fleet_summary(curated.read_state(spark, settings.output)).first()
    assert (summary.total_vehicles, summary.total_events, summary.total_faults) == (2, 3, 1)

    counters = metrics.read_metrics(spark, settings.output)
    totals = {r.metric: r.total for r in counters.groupBy("metric").agg(F.sum("value").alias("total")).collect()}
    assert totals == {
        "BatchesProcessed": 3.0,  # the last one carried no rows, it only closed state
        "RecordsProcessed": 7.0,
        "AggregatedRecords": 3.0,
        "InvalidRecords": 3.0,
        "PipelineErrors": 0.0,
        "ApplicationStatus": 1.0,
    }

    # What the job printed is readable as a log and tells the same story.
    log = f"{settings.output}.log"
    with open(log, "w") as f:
        f.write(capsys.readouterr().out)
    printed = cl.latest_window_state(console_log.read_changelog_text(spark, log))
    stored = curated.read_state(spark, settings.output)
    assert sorted(printed.select(*WINDOW_COLUMNS).collect()) == sorted(stored.select(*WINDOW_COLUMNS).collect())


def test_failing_sink_fails_the_job_and_counts_an_error(spark, script, settings, tmp_path):
    blocked = tmp_path / "out" / "curated"
    blocked.parent.mkdir()
    blocked.write_text("in the way")
    script.arrive(at("10:00:00"))
    with pytest.raises(Exception):
        job.run(spark, settings, script.stream(), NOW)
    errors = metrics.read_metrics(spark, settings.output).filter("metric = 'PipelineErrors' AND value = 1")
    assert errors.count() == 1
    assert not spark.streams.active


def test_console_query(spark, script, settings):
    script.arrive(at("10:00:00"))
    _, _, windows = job.build_frames(script.stream())
    query = job.start_console(windows, settings.checkpoint, NOW)
    query.awaitTermination()
    assert query.recentProgress[0]["numInputRows"] == 1


def test_settings_from_arguments_and_environment(monkeypatch):
    monkeypatch.setenv("SPARK_WINDOW_DURATION", "1 minute")
    got = job.parse_args(["--output", "/data/out", "--topic", "t", "--watermark-delay", "30 seconds"])
    assert (got.window_duration, got.watermark_delay, got.topic, got.output) == ("1 minute", "30 seconds", "t", "/data/out")
    assert got.bootstrap_servers == "localhost:9092" and not got.console


def test_fresh_checkpoint_adds_to_earlier_output_and_wins(spark, script, settings, tmp_path):
    script.arrive(at("10:00:00", 10), "x")
    job.run(spark, settings, script.stream(), NOW)
    (tmp_path / "in" / "001.parquet").rename(tmp_path / "old.parquet")
    script.arrive(at("10:00:30", 40), at("10:10:00", 40), "y", "z")
    again = job.JobSettings(**{**vars(settings), "checkpoint": str(tmp_path / "fresh")})
    job.run(spark, again, script.stream(), NOW)
    assert state(spark, settings) == {("BMW-1", "10:00"): (1, 40.0), ("BMW-1", "10:10"): (1, 40.0)}
    assert curated.read_curated(spark, settings.output).count() == 3
    assert spark.read.parquet(f"{settings.output}/{curated.DEAD_LETTER_DIR}").count() == 3
    assert spark.read.json(f"{settings.output}/{curated.RAW_DIR}").count() == 6
    assert job.first_batch_id(spark, settings) == 0 and job.first_batch_id(spark, again) == job.RUN_BATCHES


def test_replay_after_midnight_leaves_one_copy(spark, script, settings, monkeypatch):
    script.arrive("x", at("10:00:00"))
    flagged = va.flag_events(spark.read.schema(KAFKA_RECORD).parquet(str(script.folder)))
    job.route_batch(settings)(flagged, 3)
    monkeypatch.setattr(curated, "today", lambda: "2099-01-01")
    job.route_batch(settings)(flagged, 3)
    assert spark.read.json(f"{settings.output}/{curated.RAW_DIR}").count() == 2
    assert spark.read.parquet(f"{settings.output}/{curated.DEAD_LETTER_DIR}").count() == 1


def test_first_query_failing_during_start_is_not_forgotten(spark, script, settings, tmp_path, monkeypatch):
    blocked = tmp_path / "out" / "raw"
    blocked.parent.mkdir()
    blocked.write_text("in the way")
    script.arrive(at("10:00:00"))
    start = job.start_aggregates

    def late(*args):
        deadline = time.monotonic() + 60
        while any(q.name == "route" for q in spark.streams.active) and time.monotonic() < deadline:
            time.sleep(0.2)
        return start(*args)

    monkeypatch.setattr(job, "start_aggregates", late)
    with pytest.raises(Exception):
        job.run(spark, settings, script.stream())
    assert not spark.streams.active


def test_every_failure_counts(spark, settings):
    for _ in range(3):
        metrics.emit_error(spark, settings.output)
    metrics.put(spark, settings.output, "Lag", 2.5, "Seconds")
    rows = metrics.read_metrics(spark, settings.output)
    assert rows.filter("metric = 'PipelineErrors'").agg(F.sum("value")).first()[0] == 3
    assert rows.filter("metric = 'Lag'").first().unit == "Seconds"


def test_stateful_sink_writes_few_files(spark, script, settings):
    script.arrive(*[at(f"10:{m:02d}:00", vehicle=f"BMW-{m}") for m in range(60)])
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        run_aggregates(script, job.JobSettings(**{**vars(settings), "output_files": 2}))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert curated.read_curated(spark, settings.output).count() == 60
    assert len({r[0] for r in curated.read_curated(spark, settings.output).selectExpr("_metadata.file_path").collect()}) <= 2


def test_source_and_trigger_settings():
    got = job.parse_args(
        ["--output", "o", "--starting-offsets", "earliest", "--max-offsets-per-trigger", "500", "--min-partitions", "6",
         "--fail-on-data-loss", "--trigger", "10 seconds"]
    )
    assert got.starting_offsets == "earliest"
    assert got.source_options() == {"maxOffsetsPerTrigger": "500", "minPartitions": "6", "failOnDataLoss": "true"}
    assert got.trigger_options() == {"processingTime": "10 seconds"}
    plain = job.parse_args(["--output", "o"])
    assert plain.source_options() == {"failOnDataLoss": "false"} and plain.trigger_options() is None
    assert job.parse_args(["--output", "o", "--trigger", "available-now"]).trigger_options() == {"availableNow": True}
