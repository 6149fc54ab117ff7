"""Declared schemas; nothing in the library infers one."""

from pyspark.sql import types as T

# Payload as the strict path reads it: a number in quotes does not become a number.
EVENT = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("battery_level", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("fault_code", T.StringType()),
    ]
)

# Payload as the lenient path reads it: every field as text, coerced afterwards.
EVENT_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT])

# Any JSON object; NULL exactly for payloads that are not one.
ANY_OBJECT = T.MapType(T.StringType(), T.StringType())

WINDOW_KPIS = T.StructType(
    [
        T.StructField("vehicle_id", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("average_speed", T.DoubleType()),
        T.StructField("average_battery_level", T.DoubleType()),
        T.StructField("maximum_temperature", T.DoubleType()),
        T.StructField("fault_count", T.LongType()),
        T.StructField("event_count", T.LongType()),
    ]
)
WINDOW_COLUMNS = tuple(WINDOW_KPIS.fieldNames())
WINDOW_KEY = ("vehicle_id", "window_start", "window_end")

CHANGELOG = T.StructType([*WINDOW_KPIS.fields, T.StructField("batch_id", T.LongType())])

# What the curated folder holds on disk: the aggregate plus its two partition columns.
CURATED = T.StructType(
    [*WINDOW_KPIS.fields, T.StructField("date", T.StringType()), T.StructField("batch_id", T.LongType())]
)

DEAD_LETTER = T.StructType(
    [
        T.StructField("json_payload", T.StringType()),
        T.StructField("error_reason", T.StringType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
    ]
)

KAFKA_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
