"""Registered operators against their SQL in another engine, on the whole small tables."""

from pathlib import Path

import duckdb
import pytest

from telemill.llm.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_operator_matches_sql(name, spark, duck):
    df = QUERIES[name](spark, DATA)
    want = duck.execute(SQL[name])
    columns = sorted(c[0] for c in want.description)
    assert sorted(df.columns) == columns
    order = [[c[0] for c in want.description].index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=str)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == expected
