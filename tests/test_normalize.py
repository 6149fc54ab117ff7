from conftest import event

from pyspark.sql import functions as F
import pytest

from telemill.functions import numbers, text, times
from telemill.operators.normalize import normalize_events


def normalized(records, *payloads):
    return normalize_events(records(list(payloads)), carry=["offset"]).orderBy("offset").collect()


def test_messy_event(records):
    (row,) = normalized(
        records,
        {
            "vehicle_id": " bmw-42 ",
            "timestamp": "2026-09-17T10:30:00Z",
            "speed": "70.5",
            "battery_level": "82.3",
            "temperature": "52.4",
            "fault_code": "temp_high",
        },
    )
    assert (row.vehicle_id, row.timestamp) == ("BMW-42", "2026-09-17T10:30:00+00:00")
    assert (row.speed, row.battery_level, row.temperature, row.fault_code) == (70.5, 82.3, 52.4, "TEMP_HIGH")
    assert row.normalize_error is None


def test_batch_keeps_every_record(records):
    rows = normalized(
        records,
        event(vehicle_id=" bmw-90 ", speed="65", fault_code="none"),
        event(vehicle_id="BMW-91", speed=61, fault_code="ENGINE_FAULT"),
        event(speed=..., temperature=...),
        event(speed=None),
        event(timestamp=None),
        event(vehicle_id=None, fault_code=None),
    )
    assert [r.vehicle_id for r in rows] == ["BMW-90", "BMW-91", "BMW-100", "BMW-100", "BMW-100", ""]
    assert [r.fault_code for r in rows][:2] == ["NONE", "ENGINE_FAULT"]
    assert (rows[2].speed, rows[2].temperature, rows[2].battery_level) == (0.0, 0.0, 82.3)
    assert [r.normalize_error for r in rows] == [None, None, None, "speed", "timestamp", None]
    assert rows[5].fault_code == "NONE"


def column(spark, values, fn, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r.r for r in rows.select("i", fn(F.col("c")).alias("r")).orderBy("i").collect()]


def test_iso_canonical(spark):
    cases = {
        "2026-09-17T10:30:00Z": "2026-09-17T10:30:00+00:00",
        "2026-09-17 10:30": "2026-09-17T10:30:00",
        "2026-09-17": "2026-09-17T00:00:00",
        "2026-09-17T10:30:00.5+05:30": "2026-09-17T10:30:00.500000+05:30",
        "2026-09-17T10:30:00.000-0130": "2026-09-17T10:30:00-01:30",
        "2026-09-17T10:30:00.1234567Z": "2026-09-17T10:30:00.123456+00:00",
        "2026-02-30T10:30:00Z": None,
        "10:30:00Z": None,
        "junk": None,
        None: None,
    }
    assert column(spark, cases, times.iso_canonical) == list(cases.values())


def test_fault_codes(spark):
    values = [" temp-high ", "TempHigh", "batterylow", "\tengine_fault\n", "overheat", None]
    assert column(spark, values, text.fault_code_alias) == [
        "TEMP_HIGH", "TEMP_HIGH", "BATTERY_LOW", "ENGINE_FAULT", "OVERHEAT", "NONE",
    ]
    assert column(spark, values, text.fault_code)[:3] == ["TEMP_HIGH", "TEMPHIGH", "BATTERYLOW"]


def test_numeric_text(spark):
    values = ["1", " 2.5 ", ".5", "1e3", "-3.", "1d", "0x10", "", "abc", None, "inf"]
    assert column(spark, values, numbers.numeric) == [
        1.0, 2.5, 0.5, 1000.0, -3.0, None, None, None, None, None, float("inf"),
    ]


def test_result_text_defaults(spark):
    values = ["3.7", "-3.7", "1e3", "n/a", "", None, "nan", "inf"]
    assert column(spark, values, numbers.or_zero_int) == [3, -3, 1000, 0, 0, 0, 0, 0]
    assert column(spark, values[:6], numbers.or_zero) == [3.7, -3.7, 1000.0, 0.0, 0.0, 0.0]
    assert column(spark, ["12d", "1f", "0x1p3"], numbers.or_zero) == [0.0, 0.0, 0.0]
    assert column(spark, ["12d", "1f", "0x1p3"], numbers.or_zero_int) == [0, 0, 0]


def test_rounding_decides_ties_on_the_decimal_value(spark):
    values = [1.005, 2.675, -1.005, 33.333333, 1e15 + 0.5, None]
    assert column(spark, values, numbers.round_2, "double") == [1.01, 2.68, -1.01, 33.33, 1e15 + 0.5, None]


@pytest.mark.parametrize("events, want", [(4, 75.0), (0, None)])
def test_fault_rate(spark, events, want):
    row = spark.range(1).select(numbers.fault_rate_pct(F.lit(3), F.lit(events)).alias("r")).first()
    assert row.r == want


def test_other_keys_are_kept_on_request(records):
    raw = records([event(seq=7, speed=None, depot="A"), event()])
    got = [r.extra for r in normalize_events(raw, carry=["offset"], extra=True).orderBy("offset").collect()]
    assert got == [{"seq": "7", "depot": "A"}, {}]
