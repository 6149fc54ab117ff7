"""First arrivals, late rows, counters and stored state of the streaming job."""

import random
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import event
from pyspark.sql import functions as F

from telemill.operators import dedup, validate as va
from telemill.sources import curated
from telemill.streaming import job, metrics, stored_state
from test_streaming import NOW, Script, at

CARRY = ["offset"]


@pytest.fixture
def script(spark, tmp_path):
    return Script(spark, tmp_path)


@pytest.fixture
def settings(tmp_path):
    return job.JobSettings(str(tmp_path / "checkpoint"), str(tmp_path / "out"), "5 minutes", "2 minutes")


def test_first_arrivals_equal_the_batch_twin_in_any_order(spark, records, tmp_path):
    rng = random.Random(8)
    sent = [event(vehicle_id=f"BMW-{rng.randint(1, 4)}", timestamp=f"2026-09-17T10:{rng.randint(0, 20):02d}:00Z", speed=float(i)) for i in range(300)]
    frame = records([*sent, *[event(speed=float(i)) for i in range(200)]]).select("value", "timestamp", "offset")
    closing = records([event(vehicle_id="BMW-LAST", timestamp="2026-12-01T00:00:00Z")]).select("value", "timestamp", "offset")
    folder = str(tmp_path / "in")

    def events(df):
        return va.valid_events(va.flag_events(df, carry=CARRY), CARRY)

    for part in (3, 1, 0, 2, None):  # later offsets in earlier runs
        (closing if part is None else frame.filter(F.col("offset") % 4 == part)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(frame.schema).parquet(folder)
        first = dedup.first_arrival_stream(events(stream), "10 days", "offset")
        writer = first.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        writer.trigger(**NOW).start().awaitTermination()
    want = dedup.first_arrival(events(frame), CARRY)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_first_arrivals_shrink_before_the_shuffle(spark, records, plan_of):
    frame = va.valid_events(va.flag_events(records([event()]), carry=CARRY), CARRY)
    plan = plan_of(dedup.first_arrival_stream(frame, "1 minute", "offset"))
    assert "partial_min_by" in plan


def test_final_windows_of_first_arrivals(spark, records, settings, tmp_path):
    rows = records([at("10:00:00", 10), at("10:00:00", 99), at("10:01:00", 20), at("11:00:00", 1), at("12:00:00", 1)])
    folder = str(tmp_path / "in")
    for keep in ("offset = 1", "offset in (0, 2)", "offset = 3", "offset = 4"):
        rows.filter(keep).write.mode("append").parquet(folder)
        slow = replace(settings, watermark_delay="30 minutes")
        job.start_final_windows(spark.readStream.schema(rows.schema).parquet(folder), slow, NOW, arrival="offset").awaitTermination()
    got = spark.read.parquet(f"{settings.output}/final_windows").orderBy("window_start").collect()
    assert [(r.event_count, r.average_speed) for r in got] == [(2, 15.0), (1, 1.0)]


def test_late_rows_are_accounted_for(spark, script, settings):
    script.arrive(at("10:00:00", 10), at("10:00:00", 99), at("10:01:00", 20), "x")
    script.arrive(at("10:01:00", 77), at("10:02:00", 60))
    script.arrive(at("10:20:00", 5))
    script.arrive(at("10:20:30", 5), at("10:20:30", 6))
    script.arrive(at("10:04:00", 250), at("10:03:00", 250), at("10:21:00", 5))
    job.run(spark, settings, script.stream(), NOW)
    rows = metrics.read_accounts(spark, settings.output).orderBy("batch_id").collect()
    assert [(r.batch_id, r.valid, r.accepted, r.duplicates, r.late) for r in rows] == [
        (0, 3, 2, 1, 0),
        (1, 2, 1, 1, 0),
        (2, 1, 1, 0, 0),
        (3, 2, 1, 1, 0),
        (4, 3, 1, 0, 2),
    ]
    assert all(r.valid == r.accepted + r.duplicates + r.late for r in rows)


def test_counters_cost_no_job_and_few_files(spark, script, settings):
    for i in range(5):
        script.arrive(at(f"10:0{i}:00", 10), "x")
    job.run(spark, settings, script.stream(), NOW)
    days = list(Path(settings.output, metrics.METRICS_DIR).glob("date=2026-09-17/query=*"))
    assert {d.name for d in days} == {"query=route", "query=aggregates"}
    assert all(len(list(d.rglob("*.parquet"))) == 1 for d in days)
    rows = metrics.read_metrics(spark, settings.output, ("2026-09-17", "2026-09-17"))
    totals = {r.metric: r.v for r in rows.groupBy("metric").agg(F.sum("value").alias("v")).collect()}
    assert (totals["RecordsProcessed"], totals["InvalidRecords"], totals["AggregatedRecords"], totals["BatchesProcessed"]) == (10, 5, 5, 5)

    flagged = va.flag_events(spark.read.schema(script.stream().schema).parquet(str(script.folder))).persist()
    flagged.count()
    quiet, loud = (replace(settings, output=f"{settings.output}-{n}", emit_metrics=n) for n in (False, True))

    def jobs(work):
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup("counted", "counted")
        before = len(tracker.getJobIdsForGroup("counted"))
        work()
        return len(tracker.getJobIdsForGroup("counted")) - before

    batch = curated.read_curated(spark, settings.output).drop("batch_id", "date").persist()
    batch.count()
    for make, frame in ((job.route_batch, flagged), (job.aggregate_batch, batch)):
        with_, without = jobs(lambda: make(loud)(frame, 1)), jobs(lambda: make(quiet)(frame, 1))
        assert with_ - without <= 1, "only the row of counters itself is written"
    flagged.unpersist(), batch.unpersist()


def test_slots_bound_the_files_of_a_day_and_survive_a_restart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(metrics, "SLOT", 4)
    for start in (0, 5):  # a restart in the middle of a slot
        ledger = metrics.Ledger(spark, str(tmp_path / "m"))
        for batch in range(start, start + 6):
            ledger.put("q", batch, "2026-09-17" if batch < 9 else None, [(batch, "Lag", float(start), "Seconds")])
    assert len(list(tmp_path.glob("m/date=2026-09-17/query=q/slot=*/*.parquet"))) == 3
    rows = spark.read.schema(f"{metrics.POINT}, date string").parquet(str(tmp_path / "m")).collect()
    assert sorted((r.batch_id, r.value) for r in rows) == [(b, 0.0 if b < 5 else 5.0) for b in range(11)]
    assert {r.date for r in rows if r.batch_id > 8} == {"unknown"}


def test_replayed_append_leaves_one_copy(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS replayed LOCATION '{tmp_path}/replayed.db'")
    row = "('BMW-1', timestamp'2026-09-17 10:00:00', timestamp'2026-09-17 10:05:00', 1D, 1D, 1D, 0L, {}L)"
    names = "t(vehicle_id, window_start, window_end, average_speed, average_battery_level, maximum_temperature, fault_count, event_count)"
    frame = lambda n: spark.sql(f"SELECT * FROM VALUES {row.format(n)} AS {names}")
    for batch, count in ((0, 1), (1, 2), (1, 3), (2, 4)):
        curated.append_batch(frame(count), "replayed.t", batch)
    assert sorted(map(tuple, spark.table("replayed.t").select("batch_id", "event_count").collect())) == [(0, 1), (1, 3), (2, 4)]
    curated.append_batch(frame(1).limit(0), "replayed.t", 2)
    assert spark.table("replayed.t").count() == 2
    with pytest.raises(Exception, match="vehicle_id must not be null"):
        curated.append_batch(frame(1).withColumn("vehicle_id", F.lit(None).cast("string")), "replayed.t", 3)
    spark.sql("DROP DATABASE replayed CASCADE")


def test_stored_state_is_what_a_restart_goes_on_from(spark, script, settings):
    script.arrive(at("10:00:00", 10), at("10:01:00", 30))
    job.start_aggregates(script.stream(), settings, NOW).awaitTermination()
    script.arrive(at("10:02:00", 50), at("10:06:00", 1, fault_code="TEMP_HIGH"))
    job.start_aggregates(script.stream(), settings, NOW).awaitTermination()
    path = f"{settings.checkpoint}/aggregates"
    got = {r.window_start.minute: (r.event_count, r.average_speed, r.fault_count) for r in stored_state.stored_windows(spark, path).collect()}
    assert got == {0: (3, 30.0, 0), 5: (1, 1.0, 1)}
    assert stored_state.stored_windows(spark, path, batch_id=0).count() == 1
    (events,) = stored_state.operator_ids(spark, path, stored_state.DEDUPLICATE)
    assert {r.key.event_timestamp.minute for r in stored_state.read_state(spark, path, events).collect()} == {6}
    script.arrive(at("10:30:00"))
    job.start_aggregates(script.stream(), settings, NOW).awaitTermination()
    assert {r.window_start.minute for r in stored_state.stored_windows(spark, path).collect()} == {30}
