"""Stored versions of the compacted state: loss, retention, differences, rollups and early stops."""

import datetime as dt
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from telemill.operators import analytics as an, changelog as cl, rollups
from telemill.schema import WINDOW_KPIS
from telemill.sources import curated, versions

UTC = dt.timezone.utc
RUN = 1_000_000


def window(vehicle, day, hour=10, events=1, faults=0, speed=50.0):
    start = dt.datetime(2026, 9, day, hour, tzinfo=UTC)
    return (f"BMW-{vehicle}", start, start + dt.timedelta(hours=1), speed, 80.0, 20.0, faults, events)


@pytest.fixture
def store(spark, tmp_path):
    base = str(tmp_path / "out")

    def write(batch, *rows):
        curated.write_curated(spark.createDataFrame(list(rows), WINDOW_KPIS), base, batch, curated.event_date())

    return base, write


def rows_of(df):
    return sorted(map(str, df.collect()))


def check(spark, base, changelog):
    """The stored state equals that of all batches ever written."""
    want = cl.latest_window_state(spark.createDataFrame([(*r, b) for b, rows in changelog for r in rows], "vehicle_id string, window_start timestamp, window_end timestamp, average_speed double, average_battery_level double, maximum_temperature double, fault_count long, event_count long, batch_id long"))
    got = versions.read_compacted_state(spark, base)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_batches_of_an_older_run_that_come_later_are_merged(spark, store):
    base, write = store
    log = [(0, [window("A", 1)]), (RUN, [window("B", 1), window("A", 1, events=5)]), (1, [window("C", 1), window("A", 1, events=3)])]
    for batch, rows in log[:2]:
        write(batch, *rows)
    assert versions.compact(spark, base).number == 1
    write(1, *log[2][1])
    check(spark, base, log)
    versions.compact(spark, base)
    check(spark, base, log)
    assert {r.vehicle_id for r in versions.read_stored(spark, base).collect()} == {"BMW-A", "BMW-B", "BMW-C"}


def test_incremental_compaction_touches_only_changed_dates(spark, store, plan_of):
    base, write = store
    log = []
    for batch in range(5):
        rows = [window(v, day, events=batch + 1, faults=batch % 2) for v in "AB" for day in ((1, 4) if batch % 2 else (1,))]
        write(batch, *rows)
        log.append((batch, rows))
        if batch in (1, 2):
            versions.compact(spark, base, up_to_batch=batch)
        check(spark, base, log)
    one, two = (versions.read_version(spark, base, n) for n in (1, 2))
    assert one.dates["2026-09-04"] == two.dates["2026-09-04"] and one.dates["2026-09-01"] != two.dates["2026-09-01"]
    assert [versions.read_stored(spark, base, n).agg(F.max("event_count")).first()[0] for n in (1, 2)] == [2, 3]
    assert (two.dates["2026-09-01"].windows, two.dates["2026-09-04"].fault_windows) == (2, 2)
    assert sorted(versions.pending_batches(spark, base, two)) == [3, 4]
    some = versions.read_compacted_state(spark, base, ("2026-09-04", "2026-09-30"))
    assert {r.window_start.day for r in some.collect()} == {4}
    assert "version=" + two.dates["2026-09-01"].version not in plan_of(some)
    assert versions.compact(spark, base).number == 3 and versions.compact(spark, base).number == 3


def test_expiry_keeps_the_state_and_removes_folders(spark, store):
    base, write = store
    log = []
    for batch in range(4):
        log.append((batch, [window("A", 1, events=batch + 1), window(batch, 2)]))
        write(batch, *log[-1][1])
        if batch < 3:
            versions.compact(spark, base)
    stale = Path(base, versions.COMPACTED_DIR, "date=2026-09-01", "version=0000000002-failed")
    stale.mkdir()  # of a compaction that failed
    running = Path(base, versions.COMPACTED_DIR, "date=2026-09-01", "version=0000000004-running")
    running.mkdir()
    gone = versions.expire(spark, base, keep=2)
    assert versions.version_numbers(spark, base) == [2, 3] and not stale.exists() and running.exists()
    left = {p.name for p in Path(base, curated.CURATED_DIR).glob("date=*/batch_id=*")}
    assert left == {"batch_id=2", "batch_id=3"}  # the second version does not hold batch 2
    assert len(gone) == 2 * 2 + 1 + 2 * 2
    check(spark, base, log)
    assert versions.read_stored(spark, base, 2).filter("event_count = 2").count() == 1
    assert versions.expire(spark, base, keep=1)
    check(spark, base, log)
    with pytest.raises(ValueError):
        versions.read_version(spark, base, 2)
    with pytest.raises(ValueError):
        versions.expire(spark, base, keep=0)
    newest = versions.compact(spark, base)
    assert [(b.first, b.last) for b in newest.batches] == [(3, 3)]  # expired batches need no mention
    versions.expire(spark, base)
    assert not list(Path(base, curated.CURATED_DIR).glob("date=*/batch_id=*"))
    check(spark, base, log)
    write(4, window("Z", 9))
    check(spark, base, [*log, (4, [window("Z", 9)])])


def test_a_batch_written_again_is_merged_again(spark, store):
    base, write = store
    write(0, window("A", 1))
    versions.compact(spark, base)
    write(0, window("A", 1), window("B", 1))
    log = [(0, [window("A", 1), window("B", 1)])]
    check(spark, base, log)
    versions.compact(spark, base)
    check(spark, base, log)
    assert not versions.pending_batches(spark, base, versions.read_version(spark, base))


def test_of_two_compactions_at_once_one_fails(spark, store):
    base, write = store
    write(0, window("A", 1))
    first = versions.compact(spark, base)
    with pytest.raises(versions.VersionConflict):
        versions._commit(spark, base, versions.Version(1, {}, []))
    assert versions.read_version(spark, base) == first
    names = {p.name for p in Path(base, versions.COMPACTED_DIR, "_manifests").glob("[!.]*")}
    assert names == {"0000000001.json"}


def test_nothing_stored(spark, store):
    base, _ = store
    assert versions.read_compacted_state(spark, base).count() == 0
    assert versions.compact(spark, base) == versions.Version() and versions.expire(spark, base) == []
    assert versions.newest_windows(spark, base, 5).count() == 0 and versions.newest_end(spark, base) is None
    assert rows_of(rollups.fleet_summary(versions.read_rollups(spark, base))) == rows_of(an.fleet_summary(versions.read_compacted_state(spark, base)))


def test_compaction_does_not_deal_out_by_date_alone(spark, store):
    source = Path(versions.__file__).read_text()
    assert not re.search(r'repartition\("date"\)|"rebalance", "date"\)', source)
    base, write = store
    write(0, *[window(v, 1, hour=h) for v in range(40) for h in range(24)])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        versions.compact(spark, base)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(list(Path(base, versions.COMPACTED_DIR).glob("date=2026-09-01/version=*/*.parquet"))) == 4


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    """Twenty days in three versions and a pending batch, with many ties."""
    base, rng = str(tmp_path_factory.mktemp("history") / "out"), random.Random(3)
    for batch in range(4):
        days = range(1, 21) if batch == 0 else (3, 19) if batch == 1 else (7, 20, 21) if batch == 2 else (2, 20)
        rows = {}
        for day in days:
            for _ in range(12):
                w = window(rng.choice("ABCDE"), day, rng.choice([1, 5, 9]), batch + rng.randint(1, 4), rng.choice([0, 0, 1, 2]), rng.uniform(0, 200))
                rows[w[:3]] = w
        curated.write_curated(spark.createDataFrame(list(rows.values()), WINDOW_KPIS), base, batch, curated.event_date())
        if batch < 3:
            versions.compact(spark, base)
    return base


def test_difference_of_versions_reads_changed_dates_only(spark, history, plan_of):
    for before, after in ((1, 3), (2, 3), (0, 1), (3, 3)):
        got = versions.version_diff(spark, history, before, after)
        old = versions.read_stored(spark, history, before) if before else None
        want = cl.snapshot_diff(versions.read_stored(spark, history, after), old)
        assert rows_of(got) == rows_of(want)
    paths = set(re.findall(r"date=(2026-09-\d+)", " ".join(versions.version_diff(spark, history, 2, 3).inputFiles())))
    assert paths == {"2026-09-07", "2026-09-20", "2026-09-21"}


def test_reports_from_rollups_equal_reports_on_windows(spark, history):
    state = versions.read_compacted_state(spark, history)
    summed = versions.read_rollups(spark, history)
    for name in ("vehicle_speed_summary", "vehicle_battery_summary", "vehicle_max_temp", "vehicle_fault_distribution", "latest_window_per_vehicle", "table_totals", "fleet_summary"):
        assert getattr(rollups, name)(summed).collect() == getattr(an, name)(state).collect()
    stored = [f for f in summed.inputFiles() if "/rollup/" in f]
    windows = {re.search(r"date=([0-9-]+)", f)[1] for f in summed.inputFiles() if "/compacted/" in f}
    assert stored and windows == {"2026-09-02", "2026-09-20"}  # those that the pending batch touches


@pytest.mark.parametrize("count", [1, 3, 12, 40, 1000])
def test_newest_windows_stop_early(spark, history, count):
    state = versions.read_compacted_state(spark, history)
    some = versions.newest_windows(spark, history, count)
    for operator in (an.recent_window_metrics, an.latest_telemetry, an.latest_telemetry_desc):
        assert operator(some, count).collect() == operator(state, count).collect()
    faults = versions.newest_windows(spark, history, min(count, 500), faults=True)
    assert an.recent_faults(faults, min(count, 500)).collect() == an.recent_faults(state, min(count, 500)).collect()
    read = {re.search(r"date=([0-9-]+)", f)[1] for f in some.inputFiles() if "/compacted/" in f}
    assert len(read) <= 2 + count // 4
    end = versions.newest_end(spark, history)
    got = an.recent_windows(versions.windows_since(spark, history, end - 1800), dt.datetime.fromtimestamp(end, UTC))
    assert got.collect() == an.recent_windows(state, dt.datetime.fromtimestamp(end, UTC)).collect()


def test_files_read_do_not_grow_with_history(spark, store):
    base, write = store
    read = []
    for batch in range(3):
        write(batch, *[window(v, 1 + batch * 9 + day) for v in "AB" for day in range(9)])
        versions.compact(spark, base)
        read.append(len(versions.newest_windows(spark, base, 3).inputFiles()))
    assert read[1] == read[2]
