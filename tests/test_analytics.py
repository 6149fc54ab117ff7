import datetime as dt

import pytest
from pyspark.sql import functions as F

from telemill.operators import analytics as an
from telemill.schema import CHANGELOG

T0 = dt.datetime(2026, 9, 17, 10, 0)


def row(vehicle, minute, speed=50.0, battery=50.0, temperature=30.0, faults=0, events=2, batch=0):
    start = T0 + dt.timedelta(minutes=minute)
    return (vehicle, start, start + dt.timedelta(minutes=5), speed, battery, temperature, faults, events, batch)


@pytest.fixture(scope="module")
def state(spark):
    rows = [
        row("BMW-1", 0, speed=10.0, battery=80.0, temperature=95.0, faults=1, events=4),
        row("BMW-1", 5, speed=21.0, battery=0.0, temperature=40.0),
        row("BMW-2", 0, speed=100.0, battery=15.0, temperature=90.0, faults=0, events=1, batch=1),
        row("BMW-2", 5, speed=50.0, battery=60.0, temperature=91.0, faults=2, events=2, batch=None),
        row("BMW-3", 0, speed=None, battery=None, temperature=None, faults=None, events=0, batch=1),
    ]
    return spark.createDataFrame(rows, CHANGELOG)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], CHANGELOG)


def test_fleet_summary(state, empty):
    got = an.fleet_summary(state).first()
    assert tuple(got) == (
        3, 5, 9, 3, 45.25, 38.75, 95.0, "2026-09-17 10:00:00.000", "2026-09-17 10:10:00.000",
    )
    assert tuple(an.fleet_summary(empty).first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0, None, None)


def test_order_of_reports(state):
    def first(df, column="vehicle_id"):
        return [r[column] for r in df.collect()]

    assert first(an.vehicle_speed_summary(state)) == ["BMW-2", "BMW-1", "BMW-3"]
    assert first(an.vehicle_max_temp(state)) == ["BMW-1", "BMW-2", "BMW-3"]
    assert first(an.vehicle_fault_distribution(state)) == ["BMW-2", "BMW-1", "BMW-3"]
    assert first(an.latest_window_per_vehicle(state)) == ["BMW-1", "BMW-2", "BMW-3"]
    assert first(an.vehicle_battery_summary(state)) == ["BMW-3", "BMW-2", "BMW-1"]
    assert first(an.high_temp_windows(state), "maximum_temperature") == [95.0, 91.0]
    assert first(an.fault_windows(state), "fault_rate_pct") == [100.0, 25.0]
    assert first(an.fault_vehicles(state)) == ["BMW-1", "BMW-2"]


def test_rates_without_events_are_null(state):
    rates = {r.vehicle_id: r.fault_rate_pct for r in an.vehicle_fault_distribution(state).collect()}
    assert rates == {"BMW-1": 16.67, "BMW-2": 66.67, "BMW-3": None}


def test_newest_first(state):
    newest = [(r.vehicle_id, r.window_start) for r in an.latest_telemetry(state, 3).collect()]
    assert newest == [
        ("BMW-1", "2026-09-17 10:05:00.000"),
        ("BMW-2", "2026-09-17 10:05:00.000"),
        ("BMW-1", "2026-09-17 10:00:00.000"),
    ]
    assert [r.vehicle_id for r in an.latest_telemetry_desc(state, 3).collect()] == ["BMW-2", "BMW-1", "BMW-3"]
    assert [r.fault_count for r in an.recent_faults(state).collect()] == [2, 1]
    assert an.top_faults(state).count() == 2
    assert an.recent_window_metrics(state, 2).count() == 2


@pytest.mark.parametrize("limit", [0, -1, 1001, "5", True, None])
def test_latest_telemetry_rejects_limits(state, limit):
    with pytest.raises(ValueError):
        an.latest_telemetry(state, limit)


@pytest.mark.parametrize("limit", [0, 501])
def test_recent_faults_rejects_limits(state, limit):
    with pytest.raises(ValueError):
        an.recent_faults(state, limit)


def test_limits_use_top_k(state, plan_of):
    for df in (an.latest_telemetry(state), an.recent_faults(state), an.recent_window_metrics(state)):
        assert "TakeOrderedAndProject" in plan_of(df)


def test_recent_windows(state):
    as_of = T0 + dt.timedelta(minutes=36)
    assert [r.vehicle_id for r in an.recent_windows(state, as_of).collect()] == ["BMW-1", "BMW-2"]
    assert an.recent_windows(state, as_of, minutes=31).count() == 5
    assert an.recent_windows(state).count() == state.filter(F.col("window_end") > F.current_timestamp()).count()


def test_status(state):
    got = {(r.vehicle_id, r.window_start.minute): (r.status, r.status_label) for r in an.window_status(state).collect()}
    assert got == {
        ("BMW-1", 0): ("fault", "1 Fault"),
        ("BMW-1", 5): ("ok", "Nominal"),  # an empty battery counts as full
        ("BMW-2", 0): ("warning", "Warning"),
        ("BMW-2", 5): ("fault", "2 Faults"),
        ("BMW-3", 0): ("ok", "Nominal"),
    }


def test_sorting(state):
    speeds = [r.average_speed for r in an.sort_by_column(state, "average_speed", descending=False).collect()]
    assert speeds == [None, 10.0, 21.0, 50.0, 100.0]
    batches = [r.batch_id for r in an.sort_by_column(state, "batch_id").collect()]
    assert batches == [1, 1, 0, 0, None]
    assert an.sort_by_column(state).first().window_start.minute == 5
    for column in an.SORTABLE:
        assert an.sort_by_column(state, column).count() == 5
    with pytest.raises(ValueError):
        an.sort_by_column(state, "window_end")


def test_fault_kpis(state, empty):
    assert tuple(an.fault_kpis(state).first()) == (3, 2, 2)
    assert tuple(an.fault_kpis(empty).first()) == (0, 0, 0)


def test_table_totals(state):
    got = an.table_totals(state).first()
    assert (got.total_windows, got.earliest_window, got.latest_window) == (5, T0, T0 + dt.timedelta(minutes=10))


def test_typed_projection(spark):
    names = [f.name for f in CHANGELOG][:-1]
    rows = [
        ("BMW-100", "2026-09-17 10:00:00.000", "2026-09-17 10:05:00.000", "95.5", "78.2", "42.0", "1", "5.0"),
        (None, None, None, None, "n/a", "", "x", None),
    ]
    text = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    got = sorted(tuple(r) for r in an.typed_projection(text).collect())
    assert got == [
        ("", "", "", 0.0, 0.0, 0.0, 0, 0),
        ("BMW-100", "2026-09-17 10:00:00.000", "2026-09-17 10:05:00.000", 95.5, 78.2, 42.0, 1, 5),
    ]
