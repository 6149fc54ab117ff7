import datetime as dt

import pytest
from conftest import event
from pyspark.sql import functions as F

from telemill.operators import changelog as cl, dedup, validate as va, windows as wi
from telemill.plans import batch as plan
from telemill.schema import CHANGELOG


def e(vehicle, time, speed, battery, temperature, fault):
    return {
        "vehicle_id": f"BMW-{vehicle}",
        "timestamp": f"2026-09-17T{time}+00:00",
        "speed": speed,
        "battery_level": battery,
        "temperature": temperature,
        "fault_code": fault,
    }


EVENTS = [
    e(100, "10:00:00", 60.0, 80.0, 40.0, "NONE"),
    e(100, "10:01:00", 100.0, 60.0, 50.0, "TEMP_HIGH"),
    e(100, "10:02:00", 80.0, 40.0, 45.0, "BATTERY_LOW"),
    e(100, "10:05:00", 120.0, 30.0, 60.0, "ENGINE_FAULT"),
    e(200, "10:00:10", 50.0, 90.0, 35.0, "NONE"),
    e(200, "10:03:00", 70.0, 70.0, 38.0, "NONE"),
]
# (vehicle, start minute): speed, battery, max temperature, faults, events
GOLDEN = {
    ("BMW-100", 0): (80.0, 60.0, 50.0, 2, 3),
    ("BMW-100", 5): (120.0, 30.0, 60.0, 1, 1),
    ("BMW-200", 0): (60.0, 80.0, 38.0, 0, 2),
}


def test_window_kpis_golden(records):
    _, dead, windows = plan.ingest(records(EVENTS), "offset")
    got = {(r[0], r.window_start.minute): tuple(r[3:]) for r in windows.collect()}
    assert got == GOLDEN
    assert dead.count() == 0
    assert all(r.window_end - r.window_start == dt.timedelta(minutes=5) for r in windows.collect())


def test_rounded_windows_golden_and_sorted(records):
    rows = plan.rule_checked_summaries(records(EVENTS), 300).collect()
    got = {(r.vehicle_id, int(r.window_start[14:16])): tuple(r[3:]) for r in rows}
    assert got == GOLDEN
    assert rows[0].window_start == "2026-09-17T10:00:00+00:00" and rows[0].window_seconds == 300
    assert [(r.vehicle_id, r.window_start) for r in rows] == sorted((r.vehicle_id, r.window_start) for r in rows)


def test_rounding_and_short_windows(records):
    two = [e("X", "10:00:00", 33.333333, 50, 30, "NONE"), e("X", "10:01:00", 66.666666, 50, 30, "NONE")]
    (row,) = plan.rule_checked_summaries(records(two), 300).collect()
    assert row.avg_speed == 50.0
    assert plan.rule_checked_summaries(records(two), 60).count() == 2


@pytest.mark.parametrize("seconds", [0, -5])
def test_window_seconds_must_be_positive(records, seconds):
    with pytest.raises(ValueError):
        plan.rule_checked_summaries(records(EVENTS), seconds)


def test_offsets_group_by_instant(records):
    same = [event(timestamp="2026-09-17T10:00:00Z"), event(timestamp="2026-09-17T12:01:00+02:00")]
    (row,) = plan.ingest(records(same), "offset")[2].collect()
    assert row.event_count == 2


def test_missing_code_is_no_fault_in_the_lenient_aggregate(spark):
    rows = [("BMW-1", "2026-09-17T10:00:00Z", 1.0, 1.0, 1.0, c) for c in (None, "none", "temp_high")]
    schema = "vehicle_id string, timestamp string, speed double, battery_level double, temperature double, fault_code string"
    (row,) = wi.window_kpis_rounded(spark.createDataFrame(rows, schema)).collect()
    assert (row.fault_count, row.event_count) == (1, 3)


# --- dedup ---------------------------------------------------------------------------------


def test_first_arrival_wins_in_both_forms(records):
    raw = records([event(speed=1), event(speed=2), event(timestamp="2026-09-17T10:31:00Z", speed=3), event(speed=4)])
    valid = va.valid_events(va.flag_events(raw, carry=["offset"]), ["offset"])
    general = dedup.first_arrival(valid, ["kafka_timestamp", "offset"])
    narrow = dedup.first_measures(valid, "offset", ["speed"])
    assert sorted(r.speed for r in general.collect()) == sorted(r.speed for r in narrow.collect()) == [1.0, 3.0]
    assert general.columns == valid.columns


def test_copies_are_dropped_before_the_shuffle(records, plan_of):
    valid = va.valid_events(va.flag_events(records([event()]), carry=["offset"]), ["offset"])
    general = plan_of(dedup.first_arrival(valid, ["offset"]))
    assert general.index("Final") < general.index("Exchange") < general.index("Partial")
    narrow = plan_of(wi.batch_window_kpis(valid, "offset"))
    assert "partial_min_by" in narrow and "SortAggregate" not in narrow and "Sort [" not in narrow


def test_exact_dedup(records, spark):
    other_order = '{"speed": 70.5, "vehicle_id": "BMW-100", "timestamp": "2026-09-17T10:30:00+00:00", "battery_level": 82.3, "temperature": 52.4, "fault_code": "NONE"}'
    payloads = [event(), event(), event(), other_order, event(fault_code=None), event(fault_code=...), event(extra=1), "junk"]
    from telemill.operators.decode import decode_payload

    assert dedup.exact_dedup_payloads(decode_payload(records(payloads))).count() == 4
    rows = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert dedup.exact_dedup(rows).count() == 2
    assert dedup.exact_dedup(rows, ["k"]).count() == 1


# --- changelog -----------------------------------------------------------------------------


def test_changelog_accumulates_and_compacts_to_the_one_shot_aggregate(records):
    raw = records(EVENTS, [0, 1, 2, 1, 0, 0])
    changes = plan.changelog(raw, "offset")
    counts = {
        (r.vehicle_id, r.window_start.minute, r.batch_id): (r.event_count, r.fault_count) for r in changes.collect()
    }
    assert counts == {
        ("BMW-100", 0, 0): (1, 0),
        ("BMW-100", 0, 1): (2, 1),
        ("BMW-100", 0, 2): (3, 2),
        ("BMW-100", 5, 1): (1, 1),
        ("BMW-200", 0, 0): (2, 0),
    }
    state = cl.latest_window_state(changes)
    got = {(r[0], r.window_start.minute): tuple(r[3:8]) for r in state.collect()}
    assert got == GOLDEN
    assert [(r.batch_id, r.row_count) for r in cl.batch_counts(state).collect()] == [(2, 1), (1, 1), (0, 1)]
    assert cl.batch_filter(state, 1).count() == 1 and cl.batch_filter(state).count() == 3


def test_compaction_tolerates_replays_and_prefers_the_fuller_row(records):
    changes = plan.changelog(records(EVENTS, [0, 1, 2, 1, 0, 0]), "offset")
    twice = changes.unionByName(changes)
    assert cl.latest_window_state(twice).count() == 3
    partial = changes.withColumn("event_count", F.col("event_count") - 1)
    best = cl.latest_window_state(partial.unionByName(changes))
    assert sorted(r.event_count for r in best.collect()) == [1, 2, 3]


def test_key_filters_reach_the_scan_but_measure_filters_stay_above_compaction(spark, tmp_path, plan_of):
    path = str(tmp_path / "changes")
    spark.createDataFrame([], CHANGELOG).write.parquet(path)
    state = cl.latest_window_state(spark.read.parquet(path))
    by_key = plan_of(state.filter(F.col("vehicle_id") == "BMW-1"))
    assert "EqualTo(vehicle_id,BMW-1)" in by_key
    by_measure = plan_of(state.filter(F.col("fault_count") > 0))
    assert "GreaterThan(fault_count" not in by_measure


def test_snapshot_diff(records, spark):
    changes = plan.changelog(records(EVENTS, [0, 1, 2, 1, 0, 0]), "offset")
    now = cl.latest_window_state(changes)
    then = cl.latest_window_state(changes.filter("batch_id = 0"))
    diff = {(r.vehicle_id, r.window_start.minute): r.change for r in cl.snapshot_diff(now, then).collect()}
    assert diff == {("BMW-100", 0): "updated", ("BMW-100", 5): "new"}
    assert cl.new_window_count(cl.snapshot_diff(now, then)).first().new_windows == 1
    assert cl.snapshot_diff(now, now).count() == 0
    first = cl.snapshot_diff(now, None)
    assert first.count() == 0 and first.columns == cl.snapshot_diff(now, then).columns
