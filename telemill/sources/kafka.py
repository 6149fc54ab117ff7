"""Broker source and sink. The options are plain functions so they can be checked without the
connector; the connector itself has to be on the class path of the session that uses it."""

from __future__ import annotations

import datetime as dt
import json
import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

UNKNOWN_KEY = "unknown"


def read_options(
    bootstrap_servers: str, topic: str, starting_offsets: str = "latest", extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    """``extra`` is where rate and parallelism go (``maxOffsetsPerTrigger``, ``minPartitions``)."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
        **(extra or {}),
    }


def read_kafka_events(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Streaming frame over a topic."""
    return spark.readStream.format("kafka").options(**read_options(bootstrap_servers, topic, **kwargs)).load()


def range_options(
    bootstrap_servers: str,
    topic: str,
    starting: str | Mapping[int, int] = "earliest",
    ending: str | Mapping[int, int] = "latest",
    starting_time: dt.datetime | None = None,
    ending_time: dt.datetime | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a batch read: offsets by partition (the last one left out), or all records between two times.

    Offsets that have expired fail the read unless ``extra`` says ``failOnDataLoss=false``: what was asked
    for by number should be there.
    """
    if starting == "latest" or ending == "earliest":
        raise ValueError("a range cannot begin with the latest or end with the earliest offsets")
    place = lambda x: x if isinstance(x, str) else json.dumps({topic: {str(p): int(o) for p, o in sorted(x.items())}})
    options = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, "failOnDataLoss": "true"}
    for name, offsets, time in (("starting", starting, starting_time), ("ending", ending, ending_time)):
        if time is None:
            options[f"{name}Offsets"] = place(offsets)
        elif time.tzinfo is None:
            raise ValueError(f"{name}_time needs a time zone")
        else:
            options[f"{name}Timestamp"] = str(round(time.timestamp() * 1000))
    if starting_time is not None:
        # a partition without records that late is read from its end, not refused
        options["startingOffsetsByTimestampStrategy"] = "latest"
    return options | dict(extra or {})


def read_kafka_range(spark: SparkSession, bootstrap_servers: str, topic: str, **kwargs) -> DataFrame:
    """Batch frame over a range of a topic, for repairs and back-fills; see ``range_options``."""
    return spark.read.format("kafka").options(**range_options(bootstrap_servers, topic, **kwargs)).load()


def write_options(
    bootstrap_servers: str, topic: str, retries: int = 3, request_timeout_ms: int = 10_000, linger_ms: int = 10
) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": str(retries),
        "kafka.request.timeout.ms": str(request_timeout_ms),
        "kafka.linger.ms": str(linger_ms),
    }


def encode_messages(events: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Events as keyed JSON messages; nulls stay in the JSON, rows without a key get ``unknown``."""
    body = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return events.select(
        F.coalesce(F.col(key).cast("string"), F.lit(UNKNOWN_KEY)).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )


def producer_options(bootstrap_servers: str | None = None, topic: str | None = None, **kwargs) -> dict[str, str]:
    """``write_options`` with servers and topic from the environment where they are not given."""
    servers = bootstrap_servers or os.environ.get("KAFKA_BOOTSTRAP_SERVERS", "localhost:9092")
    return write_options(servers, topic or os.environ.get("KAFKA_TOPIC", "telemetry-events"), **kwargs)


def send_batch(
    events: DataFrame, bootstrap_servers: str | None = None, topic: str | None = None, key: str = "vehicle_id", **kwargs
) -> None:
    """Write events to a topic from the executors, keyed by the column ``key``."""
    options = producer_options(bootstrap_servers, topic, **kwargs)
    encode_messages(events, key).write.format("kafka").options(**options).save()
