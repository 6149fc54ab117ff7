import datetime as dt
import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("telemill-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(work / "warehouse"))
        .config("spark.sql.catalogImplementation", "in-memory")
        .config("spark.checkpoint.dir", str(work / "shared"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


EVENT = {
    "vehicle_id": "BMW-100",
    "timestamp": "2026-09-17T10:30:00+00:00",
    "speed": 70.5,
    "battery_level": 82.3,
    "temperature": 52.4,
    "fault_code": "NONE",
}


def event(**changes):
    """The sample event with changes; a value of ``...`` removes the key."""
    merged = {**EVENT, **changes}
    return {k: v for k, v in merged.items() if v is not ...}


@pytest.fixture(scope="session")
def records(spark):
    """Broker-shaped frame of payloads (texts, or dicts to be written as JSON)."""

    def build(payloads, batch_ids=None):
        rows = [
            (
                None if p is None else bytearray((p if isinstance(p, str) else json.dumps(p)).encode()),
                dt.datetime(2026, 9, 17, 10, 31, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=i),
                i,
                0 if batch_ids is None else batch_ids[i],
            )
            for i, p in enumerate(payloads)
        ]
        schema = "value binary, timestamp timestamp, offset bigint, batch_id bigint"
        return spark.createDataFrame(rows, schema)

    return build


@pytest.fixture(scope="session")
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
