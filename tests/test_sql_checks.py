"""Every registered query against its SQL equivalent in another engine."""

import math
from pathlib import Path

import duckdb
import pytest
from conftest import DATA

from __spark_entry__ import entry, oracle_sql, queries
from telemill.plans.checks import checks
from telemill.plans.registry import QUERIES
from telemill.sources import feed
from telemill.sources.scratch import scratch_scope
from telemill.operators import validate as va, windows as wi
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


def test_every_query_has_a_check():
    assert set(QUERIES) == set(checks())
    assert set(QUERIES) <= set(queries()) and set(checks()) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    expected = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    got, want = _rows(df.columns, df.collect()), _rows(columns, expected.fetchall())
    assert want, "the check itself must return rows"
    assert got == want


def test_batches_of_the_stream_do_not_follow_the_files(spark, tmp_path):
    name, found = "stream_window_state_batches", []
    ts = "timestamp_ntz'2024-01-01' + make_dt_interval(id % 20, 0, 0, id / 1000)"
    kind, charge = "element_at(array('view', 'click', 'error'), int(id % 3) + 1)", """concat('{"k": ', id % 100, '}')"""
    events = spark.range(400).selectExpr(
        "id AS event_id", f"{ts} AS ts", "id % 13 AS user_id", f"{kind} AS event_type", "id % 90 + 0.5D AS value", f"{charge} AS props"
    )
    for files in (1, 5):
        folder = tmp_path / str(files)
        events.repartition(files).write.parquet(f"{folder}/events.parquet")
        with scratch_scope(spark) as made:
            df = QUERIES[name](spark, str(folder))
            got = _rows(df.columns, df.collect())
            commits = [p for place in made for p in Path(place).glob("checkpoint/aggregates/commits/[0-9]*")]
        found.append(len(commits))
        con = duckdb.connect()
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
        expected = con.execute(oracle_sql()[name])
        assert got and got == _rows([c[0] for c in expected.description], expected.fetchall())
    assert found[0] == found[1] >= 3


def test_entry(spark):
    assert entry(spark).count() == 10


def test_feed_without_payload_defects_has_the_known_counts(spark):
    records = feed.read_feed(spark, DATA, defects=False)
    flagged = va.flag_events(records, carry=["offset"])
    valid = va.valid_events(flagged, ["offset"])
    assert (records.count(), valid.count()) == (1100, 913)
    windows = wi.batch_window_kpis(valid, "offset", "6 hours")
    got = windows.agg(
        F.count(F.lit(1)),
        F.countDistinct("vehicle_id"),
        F.sum("event_count"),
        F.sum("fault_count"),
        F.max("maximum_temperature"),
        F.count_if(F.col("fault_count") > 0),
        F.round(F.sum("average_speed"), 6),
    ).first()
    assert tuple(got) == (594, 10, 847, 505, 120.0, 404, 27953.318333)
