"""Telemetry feed derived from an ``events(event_id, ts, user_id, event_type, value, props)`` table.

Turns each event into a broker record as a vehicle would have sent it: about one in seven with a
defect of a known kind, one in ten sent twice. Everything is a function of the row, so the mapping
is one narrow projection over the table and another engine can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Defect kinds by divisor of event_id, first match wins (fixed values shared with the SQL checks).
DEFECTS = (
    (109, "not_json"),
    (113, "truncated"),
    (127, "empty_array"),
    (131, "empty_object"),
    (137, "empty_text"),
    (139, "null_value"),
    (149, "object_in_array"),
    (151, "trailing_text"),
    (157, "quoted_speed"),
    (163, "text_speed"),
    (167, "nan_temperature"),
    (173, "numeric_id"),
    (179, "absent_temperature"),
    (181, "null_fault"),
    (191, "absent_id"),
    (193, "json_null"),
    (197, "tab_id"),
    (199, "alias_fault"),
    (211, "basic_offset"),
    (223, "time_only"),
    (227, "east_offset"),
    (229, "null_battery"),
)
BATCHES = 3


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def telemetry_view(events: DataFrame, defects: bool = True, wide: bool = False) -> DataFrame:
    """Typed view of the feed, one row per transmission.

    Without ``defects`` only the mistakes a typed row can carry remain (bad ids, times, ranges,
    codes) and the second transmission of an event equals the first. ``wide`` makes every user a
    vehicle and every day a batch, so that keys grow with the table; otherwise there are ten
    vehicles and ``BATCHES`` batches at any size.
    """
    cases = " ".join(f"WHEN event_id % {n} = 0 THEN '{kind}'" for n, kind in DEFECTS)
    sent = events.selectExpr(
        "event_id",
        "explode(if(event_id % 10 = 0, array(0, 1), array(0))) AS copy_no",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS iso",
        "CAST(ts AS TIMESTAMP) AS kafka_timestamp",
        f"CAST({'user_id' if wide else 'user_id % 10'} AS STRING) AS unit",
        f"{'unix_date(CAST(ts AS DATE))' if wide else f'event_id % {BATCHES}'} AS batch_id",
        "event_type",
        "value",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS charge",
        f"CASE {cases} ELSE '' END AS defect" if defects else "'' AS defect",
    )
    # Every other second transmission carries a corrected reading, so it matters which one is kept.
    revised = f"copy_no = 1 AND event_id % 20 = 0 AND {str(defects).lower()}"
    return sent.selectExpr(
        "event_id",
        "event_id * 2 + copy_no AS offset",
        "batch_id",
        "kafka_timestamp",
        "defect",
        r"""CASE WHEN defect = 'numeric_id' THEN '42' WHEN defect = 'absent_id' THEN NULL
             WHEN defect = 'tab_id' THEN concat('\tBMW-', unit)
             WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN concat('CAR-', unit)
             ELSE concat(if(event_id % 2 = 0, ' BMW-', ' bmw-'), unit, ' ') END AS vehicle_id""",
        """CASE WHEN event_id % 101 = 0 THEN 'not-a-date' WHEN event_id % 103 = 0 THEN iso
             WHEN defect = 'time_only' THEN '10:30:00Z'
             ELSE concat(iso, CASE defect WHEN 'basic_offset' THEN '+0000' WHEN 'east_offset' THEN '+02:00'
                         ELSE 'Z' END) END AS timestamp""",
        f"value + if({revised}, 1.0D, 0.0D) AS speed",
        "CASE WHEN defect = 'null_battery' THEN NULL WHEN event_id % 107 = 0 THEN 120.0D ELSE charge END AS battery_level",
        """CASE WHEN defect = 'absent_temperature' THEN NULL WHEN defect = 'nan_temperature' THEN DOUBLE('NaN')
             ELSE event_id % 150 - 25.0D END AS temperature""",
        """CASE WHEN defect = 'null_fault' THEN NULL WHEN defect = 'alias_fault' THEN 'temphigh'
             WHEN event_type = 'view' THEN 'none' WHEN event_type = 'signup' THEN 'NONE'
             WHEN event_type = 'click' THEN 'temp-high' WHEN event_type = 'error' THEN ' Engine_Fault '
             WHEN event_id % 5 = 0 THEN 'overheat' ELSE 'battery_low' END AS fault_code""",
    )


# The view's row as JSON text, written out so that its exact form is known.
_BODY = r"""concat('{',
  CASE defect WHEN 'absent_id' THEN '' WHEN 'numeric_id' THEN '"vehicle_id": 42, '
       ELSE concat('"vehicle_id": "', replace(vehicle_id, '\t', '\\t'), '", ') END,
  '"timestamp": "', timestamp, '", "speed": ',
  CASE defect WHEN 'quoted_speed' THEN concat('"', speed, '"') WHEN 'text_speed' THEN '"fast"'
       ELSE CAST(speed AS STRING) END,
  ', "battery_level": ', coalesce(CAST(battery_level AS STRING), 'null'), ', ',
  CASE defect WHEN 'absent_temperature' THEN '' ELSE concat('"temperature": ', temperature, ', ') END,
  '"fault_code": ', coalesce(concat('"', fault_code, '"'), 'null'), '}')"""
_PAYLOAD = """CASE defect WHEN '' THEN body
  WHEN 'not_json' THEN 'not json' WHEN 'truncated' THEN concat('{"vehicle_id": "', vehicle_id, '", "speed":')
  WHEN 'empty_array' THEN '[]' WHEN 'empty_object' THEN '{}' WHEN 'empty_text' THEN '' WHEN 'null_value' THEN NULL
  WHEN 'object_in_array' THEN concat('[', body, ']') WHEN 'json_null' THEN 'null'
  WHEN 'trailing_text' THEN concat(body, ' trailing') ELSE body END"""


def kafka_records(view: DataFrame) -> DataFrame:
    """Broker-shaped records of the view (``key``, ``value``, ``timestamp``, ``offset``) plus the
    originating ``event_id`` and its micro-batch."""
    ids = ("offset", "event_id", "batch_id")
    return view.selectExpr(*ids, "kafka_timestamp", "vehicle_id", "defect", f"{_BODY} AS body").selectExpr(
        "CAST(coalesce(vehicle_id, 'unknown') AS BINARY) AS key",
        f"CAST({_PAYLOAD} AS BINARY) AS value",
        "kafka_timestamp AS timestamp",
        *ids,
    )


def read_feed(spark: SparkSession, sf_dir: str, defects: bool = True, wide: bool = False) -> DataFrame:
    return kafka_records(telemetry_view(events_table(spark, sf_dir), defects, wide))
