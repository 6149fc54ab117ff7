import datetime as dt
import json
from pathlib import Path

import pytest
from conftest import event
from pyspark.sql import functions as F

from telemill.operators import analytics as an, changelog as cl
from telemill.schema import CHANGELOG, EVENT, WINDOW_KPIS
from telemill.sources import console_log, curated, kafka
from telemill.sources.scratch import scratch_dir, scratch_scope
from telemill.streaming import metrics

T0 = dt.datetime(2026, 9, 17, 10, 0)
ROWS = [
    ("BMW-101", T0, T0 + dt.timedelta(minutes=5), 95.5, 78.2, 42.0, 1, 5),
    ("BMW-202", T0, T0 + dt.timedelta(minutes=5), 110.0, 65.0, 55.0, 0, 3),
]


@pytest.fixture
def base(spark, tmp_path):
    return str(tmp_path / "out")


@pytest.fixture(scope="module")
def windows(spark):
    return spark.createDataFrame(ROWS, WINDOW_KPIS)


def files(base, pattern):
    return sorted(str(p.relative_to(base)) for p in Path(base).glob(pattern))


# --- broker --------------------------------------------------------------------------------


def test_kafka_options():
    assert kafka.read_options("kafka:9092", "telemetry") == {
        "kafka.bootstrap.servers": "kafka:9092",
        "subscribe": "telemetry",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
    }
    assert kafka.read_options("k", "t", "earliest", {"minPartitions": "64"})["minPartitions"] == "64"
    written = kafka.write_options("kafka:9092", "telemetry", retries=4)
    assert (written["kafka.acks"], written["kafka.retries"], written["kafka.linger.ms"]) == ("all", "4", "10")


def test_encoding_keeps_nulls_and_keys_by_vehicle(spark):
    rows = spark.createDataFrame([("BMW-1", "t", 42.0, None, 1.0, "NONE"), (None,) * 6], EVENT)
    got = [(bytes(r.key).decode(), json.loads(bytes(r.value))) for r in kafka.encode_messages(rows).collect()]
    assert [k for k, _ in got] == ["BMW-1", "unknown"]
    assert got[0][1] == {
        "vehicle_id": "BMW-1", "timestamp": "t", "speed": 42.0, "battery_level": None, "temperature": 1.0, "fault_code": "NONE",
    }
    assert set(got[1][1]) == set(EVENT.fieldNames())


# --- files ---------------------------------------------------------------------------------


def test_curated_layout_and_replay(spark, windows, base):
    curated.write_curated(windows, base, 5, "2026-09-17")
    curated.write_curated(windows, base, 6, "2026-09-17")
    curated.write_curated(windows, base, 5, "2026-09-17")
    parts = {str(Path(f).parent) for f in files(base, "**/*.parquet")}
    assert parts == {f"curated/telemetry/date=2026-09-17/batch_id={b}" for b in (5, 6)}
    assert curated.read_curated(spark, base).count() == 4
    assert curated.read_state(spark, base).count() == 2


def test_default_date_is_today(spark, windows, base):
    curated.write_curated(windows, base, 1)
    assert curated.read_curated(spark, base).first().date == curated.today()


def test_dates_prune_partitions(spark, windows, base, plan_of):
    curated.write_curated(windows, base, 1, curated.event_date())
    pruned = curated.read_curated(spark, base, ("2026-09-17", "2026-09-18"))
    assert "PartitionFilters: [isnotnull(date" in plan_of(pruned)
    assert pruned.count() == 2 and curated.read_curated(spark, base, ("2026-09-18", "2026-09-19")).count() == 0


def test_empty_batches_write_no_data(spark, windows, base):
    none = windows.filter("false")
    curated.write_curated(none, base, 1)
    curated.write_raw(none, base, 1)
    curated.write_dead_letter(none, base, 1)
    assert not files(base, "**/date=*") and not files(base, "**/*.parquet")


def test_raw_json_is_line_delimited(spark, windows, base):
    curated.write_raw(windows, base, 7, "2026-09-17")
    (part,) = {str(Path(f).parent) for f in files(base, "**/*.json")}
    assert part == "raw/telemetry/date=2026-09-17/batch_id=7"
    lines = [json.loads(x) for f in files(base, "**/*.json") for x in (Path(base) / f).read_text().splitlines()]
    assert sorted(x["vehicle_id"] for x in lines) == ["BMW-101", "BMW-202"]


def test_json_batch_prefix_and_overwrite(spark, windows, base):
    for _ in range(2):
        path = curated.write_json_batch(windows, base, 2)
    assert path.endswith("aggregated/batch-2")
    assert sorted(spark.read.schema(WINDOW_KPIS).json(path).collect()) == sorted(windows.collect())


def test_write_errors_are_not_swallowed(spark, windows, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    with pytest.raises(Exception):
        curated.write_curated(windows, str(blocked), 1)


# --- catalog -------------------------------------------------------------------------------


def test_sql_over_the_catalog_table_agrees_with_the_operators(spark, windows, base):
    curated.write_curated(windows, base, 1, "2026-09-17")
    name = curated.create_curated_table(spark, base, "fleet_db")
    curated.repair_table(spark, name)
    assert [r.partition for r in curated.show_partitions(spark, name).collect()] == ["date=2026-09-17/batch_id=1"]
    curated.write_curated(windows.withColumn("event_count", F.col("event_count") + 1), base, 2, "2026-09-18")
    assert spark.table(name).count() == 2
    curated.repair_table(spark, name)
    assert spark.table(name).count() == 4

    state = cl.latest_window_state(spark.table(name))
    state.createOrReplaceTempView("latest_windows")
    by_sql = spark.sql(
        "SELECT vehicle_id, sum(fault_count) AS total_faults, sum(event_count) AS total_events, "
        "round(100.0 * sum(fault_count) / nullif(sum(event_count), 0), 2) AS fault_rate_pct "
        "FROM latest_windows GROUP BY vehicle_id ORDER BY total_faults DESC"
    )
    want = [tuple(r) for r in an.vehicle_fault_distribution(state).collect()]
    assert [(r[0], r[1], r[2], float(r[3])) for r in by_sql.collect()] == want == [
        ("BMW-101", 1, 6, 16.67),
        ("BMW-202", 0, 4, 0.0),
    ]
    recent = spark.sql("SELECT * FROM latest_windows WHERE window_end >= current_timestamp() - INTERVAL '30' MINUTE")
    assert recent.count() == an.recent_windows(state).count()


def test_append_table(spark, windows, base):
    curated.create_database(spark, base, "append_db")
    curated.append_table(windows, "append_db.aggregates")
    curated.append_table(windows, "append_db.aggregates")
    curated.append_table(windows.filter("false"), "append_db.aggregates")
    assert spark.table("append_db.aggregates").count() == 4
    with pytest.raises(Exception, match="window_start must not be null"):
        curated.append_table(windows.withColumn("window_start", F.lit(None).cast("timestamp")), "append_db.aggregates")


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a != b and a.startswith(shared)


def test_options_of_a_range_of_a_topic():
    got = kafka.range_options("k:1", "t", {1: 5, 0: 7}, {0: 9, 1: -1}, extra={"minPartitions": "9"})
    assert got == {
        "kafka.bootstrap.servers": "k:1",
        "subscribe": "t",
        "failOnDataLoss": "true",
        "startingOffsets": '{"t": {"0": 7, "1": 5}}',
        "endingOffsets": '{"t": {"0": 9, "1": -1}}',
        "minPartitions": "9",
    }
    noon = dt.datetime(2026, 9, 17, 12, tzinfo=dt.timezone.utc)
    timed = kafka.range_options("k:1", "t", starting_time=noon)
    assert timed["startingTimestamp"] == "1789646400000" and timed["endingOffsets"] == "latest" and "startingOffsets" not in timed
    for wrong in ({"starting": "latest"}, {"ending": "earliest"}, {"ending_time": dt.datetime(2026, 9, 17)}):
        with pytest.raises(ValueError):
            kafka.range_options("k:1", "t", **wrong)


def test_scratch_scope_removes_what_was_made_inside(spark, tmp_path):
    from telemill.plans.registry import QUERIES

    outside = scratch_dir(spark, "outside")
    spark.range(1).write.parquet(outside)
    with scratch_scope(spark) as made:
        rows = QUERIES["compacted_state"](spark, "/root/testdata/sf0.001").count()
        with scratch_scope(spark) as inner:
            spark.range(1).write.parquet(scratch_dir(spark, "inner"))
        assert made and all(Path(p).exists() for p in made) and not Path(inner[0]).exists()
    assert rows and not any(Path(p).exists() for p in made) and Path(outside).exists()
    with pytest.raises(KeyError):
        with scratch_scope(spark) as made:
            spark.range(1).write.parquet(scratch_dir(spark, "failed"))
            raise KeyError
    assert not Path(made[0]).exists()


# --- metrics -------------------------------------------------------------------------------


def test_batch_metrics(spark, base):
    for _ in range(2):  # a replay replaces
        metrics.emit_batch_metrics(spark, base, "route", 3, records_processed=30, invalid_records=3)
    got = {r.metric: (r.batch_id, r.value, r.unit) for r in metrics.read_metrics(spark, base).collect()}
    assert metrics.read_metrics(spark, base).count() == 5
    assert got == {
        "BatchesProcessed": (3, 0.0, "Count"),
        "RecordsProcessed": (3, 30.0, "Count"),
        "AggregatedRecords": (3, 0.0, "Count"),
        "InvalidRecords": (3, 3.0, "Count"),
        "PipelineErrors": (3, 0.0, "Count"),
    }


def test_status_metric_and_failures_only_warn(spark, base, tmp_path):
    metrics.emit_status(spark, base, True)
    metrics.emit_status(spark, base, False)
    assert sorted(r.value for r in metrics.read_metrics(spark, base).collect()) == [0.0, 1.0]
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    metrics.emit_batch_metrics(spark, str(blocked), "route", 1)


# --- console logs --------------------------------------------------------------------------


def console_lines(batches):
    for batch, rows in batches:
        yield from ["-" * 43, f"Batch: {batch}", "-" * 43, "+---+", "|vehicle_id|window_start|...|", "+---+"]
        for vehicle, minute, faults, events in rows:
            start = T0 + dt.timedelta(minutes=minute)
            cells = [vehicle, start, start + dt.timedelta(minutes=1), "190.43", "82.99", "62.15", faults, events]
            yield "|" + "|".join(str(c).ljust(12) for c in cells) + "|"
        yield from ["+---+", ""]


def test_console_log(spark, tmp_path):
    log = tmp_path / "spark.log"
    lines = list(console_lines([(0, [("BMW-684", 0, 0, 1), ("BMW-927", 0, 1, 1)]), (1, [("BMW-684", 0, 2, 4)])]))
    junk = ["Batch: x", "|BMW-1|a|b|", "|BMW-2|2026|2026|n/a|1|1|1|1|", "|BMW-3|2026|2026|1|1|1|1.5|1|", "WARN x", "|CAR-1|a|b|1|1|1|1|1|"]
    log.write_text("\n".join(["|BMW-9|2026-09-17 10:00:00|2026-09-17 10:01:00|1|1|1|0|1|", *lines, *junk]))
    rows = console_log.read_changelog_text(spark, str(log))
    assert sorted((r.vehicle_id, r.batch_id, r.event_count) for r in rows.collect() if r.batch_id is not None) == [
        ("BMW-684", 0, 1),
        ("BMW-684", 1, 4),
        ("BMW-927", 0, 1),
    ]
    assert [r.vehicle_id for r in rows.filter("batch_id IS NULL").collect()] == ["BMW-9"]
    state = cl.latest_window_state(rows)
    assert [(r.vehicle_id, r.fault_count) for r in an.latest_telemetry_desc(state).collect()] == [
        ("BMW-927", 1),
        ("BMW-9", 0),
        ("BMW-684", 2),
    ]


def test_empty_console_log(spark, tmp_path):
    log = tmp_path / "empty.log"
    log.write_text("")
    state = cl.latest_window_state(console_log.read_changelog_text(spark, str(log)))
    assert state.count() == 0
    assert an.fleet_summary(state).first().total_windows == 0


def test_headings_carry_over_splits_of_one_log(spark, tmp_path):
    batches = [(b, [(f"BMW-{v}", b, v % 3, b + 1) for v in range(b % 7 * 20)]) for b in range(40)]
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("\n".join(console_lines(batches)))
    want = sorted((v, b) for b, rows in batches for v, *_ in rows) * 2
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 100
        rows = console_log.read_changelog_text(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)
    assert sorted((r.vehicle_id, r.batch_id) for r in rows) == sorted(want)


def test_producer_settings_from_the_environment(monkeypatch):
    monkeypatch.setenv("KAFKA_TOPIC", "other")
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "b:1")
    options = kafka.producer_options(retries=5)
    assert (options["topic"], options["kafka.bootstrap.servers"], options["kafka.retries"]) == ("other", "b:1", "5")
    assert kafka.producer_options("c:2", "mine")["topic"] == "mine"


def test_later_lines_of_a_log_win_over_larger_batch_ids(spark, tmp_path):
    row = "|BMW-1|2026-09-17 10:00:00|2026-09-17 10:05:00|{}|80.0|20.0|0|{}|"
    log = tmp_path / "job.log"
    log.write_text("Batch: 5\n" + row.format(50.0, 9) + "\nBatch: 0\n" + row.format(10.0, 1) + "\n")
    (got,) = console_log.latest_printed_state(spark, str(log)).collect()
    assert (got.batch_id, got.average_speed, got.event_count) == (0, 10.0, 1)
