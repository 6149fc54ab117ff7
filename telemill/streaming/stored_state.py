"""What a streaming query keeps in its checkpoint, as a batch frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Spark's names of the stateful operators of the job.
AGGREGATE, DEDUPLICATE = "stateStoreSave", "dedupe"


def operator_ids(spark: SparkSession, checkpoint: str, name: str) -> list[int]:
    """Ids of a query's stateful operators of one kind."""
    found = spark.read.format("state-metadata").load(checkpoint).filter(F.col("operatorName") == name)
    return sorted({r.operatorId for r in found.select("operatorId").collect()})


def read_state(spark: SparkSession, checkpoint: str, operator_id: int, batch_id: int | None = None) -> DataFrame:
    """``key, value, partition_id`` as of the last committed micro-batch, or of an earlier one."""
    reader = spark.read.format("statestore").option("operatorId", operator_id)
    return (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)


def stored_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The window aggregates that the query will go on from, in the columns of its output.

    Windows that the watermark has closed are no longer there.
    """
    (operator,) = operator_ids(spark, checkpoint, AGGREGATE)
    # buffers in the order of the aggregate's columns; renamed as a whole, as two pairs have equal names
    buffers = (
        "struct<speed_sum:double,speeds:bigint,battery_sum:double,batteries:bigint,"
        "maximum_temperature:double,fault_count:bigint,event_count:bigint>"
    )
    stored = read_state(spark, checkpoint, operator, batch_id)
    values = stored.select(F.col("key.window").alias("window"), F.col("key.vehicle_id").alias("vehicle_id"), F.col("value").cast(buffers).alias("v"))
    values = values.select("window", "vehicle_id", "v.*")
    return values.select(
        "vehicle_id",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.try_divide("speed_sum", "speeds").alias("average_speed"),
        F.try_divide("battery_sum", "batteries").alias("average_battery_level"),
        "maximum_temperature",
        "fault_count",
        "event_count",
    )
