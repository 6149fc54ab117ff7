"""Duplicate removal. Copies are collapsed before the shuffle, so a key with very many copies
never travels to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.schema import ANY_OBJECT

EVENT_KEY = ("vehicle_id", "event_timestamp")


def stream_dedup(
    valid: DataFrame, watermark: str, keys: Sequence[str] = EVENT_KEY, salts: int = 1
) -> DataFrame:
    """First arrival per key, state bounded by the event-time watermark (streaming frames).

    Streaming dedup has no map-side stage: all copies of an event meet in one task. Where one
    event may be sent very many times, ``salts`` > 1 first removes copies within that many
    sub-groups per key (split by arrival time) and only the survivors meet. Which copy survives is
    then the first of some sub-group; the price is a second state entry per key.
    """
    events = valid.withWatermark("event_timestamp", watermark)
    if salts > 1:
        salted = events.withColumn("_salt", F.pmod(F.xxhash64("kafka_timestamp"), F.lit(salts)))
        events = salted.dropDuplicates([*keys, "_salt"]).drop("_salt")
    return events.dropDuplicates(list(keys))


def first_arrival_stream(
    valid: DataFrame, watermark: str, arrival: str, keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """Streaming frames: of each event the row with the least ``arrival``, whatever order rows are read in.

    The state keeps the least row per event until the watermark has passed it; only then is the event
    emitted (append mode), so later operators see it once and for good. The aggregate has a map side:
    however many copies of one event a micro-batch holds, each task sends one. The other columns are
    those of ``first_arrival``, the batch form, to which this is equal but for late rows.
    """
    columns = [c for c in valid.columns if c not in keys]
    least = F.min_by(F.struct(*columns), arrival).alias("_first")
    events = valid.withWatermark("event_timestamp", watermark).groupBy(*keys).agg(least)
    return events.select(*[F.col(c) if c in keys else F.col(f"_first.{c}") for c in valid.columns])


def first_arrival(valid: DataFrame, arrival: Sequence[str], keys: Sequence[str] = EVENT_KEY) -> DataFrame:
    """Batch form: the row that arrived first per key, by an explicit arrival order.

    ``row_number() = 1`` plans as a group limit on both sides of the exchange: every map task
    forwards one row per key.
    """
    order = Window.partitionBy(*keys).orderBy(*arrival)
    return valid.withColumn("_nth", F.row_number().over(order)).filter("_nth = 1").drop("_nth")


def first_measures(
    valid: DataFrame, arrival: str, measures: Sequence[str], keys: Sequence[str] = EVENT_KEY
) -> DataFrame:
    """``first_arrival`` for fixed-width columns and a single arrival column.

    All buffers are fixed width, so this is a hash aggregate with partial aggregation and needs
    no sort, unlike the general form.
    """
    return valid.groupBy(*keys).agg(*[F.min_by(m, arrival).alias(m) for m in measures])


def exact_dedup(events: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct record (nulls compare equal); ``columns`` default to all."""
    return events.select(*(columns or events.columns)).distinct()


def last_entries(fields: str) -> Column:
    """Entries of a parsed object; of a key that JSON repeats, the last value holds."""
    entries = F.map_entries(fields)
    later = lambda e, i: F.exists(F.slice(entries, i + 2, F.size(entries)), lambda x: x["key"] == e["key"])
    repeated = F.size(F.array_distinct(F.map_keys(fields))) < F.size(fields)
    return F.when(repeated, F.filter(entries, lambda e, i: ~later(e, i))).otherwise(entries)


def exact_dedup_payloads(decoded: DataFrame) -> DataFrame:
    """Distinct JSON objects as a map column ``fields`` of key to text value.

    Two payloads are the same record when all their key-value pairs are, in whatever order and
    spacing; an absent key differs from a null, and of a repeated key the last value holds.
    Payloads that are not objects are left out.
    """
    # Exploding a one-element array evaluates the parse once per row. A map cannot be a grouping
    # key, its sorted entries can.
    parsed = decoded.select(F.explode(F.array(F.from_json("json_payload", ANY_OBJECT))).alias("fields"))
    entries = F.sort_array(last_entries("fields"))
    distinct = parsed.filter("fields IS NOT NULL").select(entries.alias("entries")).distinct()
    return distinct.select(F.explode(F.array(F.map_from_entries("entries"))).alias("fields"))
