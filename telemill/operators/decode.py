"""From broker records to typed events.

``inline(array(from_json(...)))`` rather than ``select("event.*")``: behind a plain projection
Catalyst turns every ``event.field`` into its own single-field ``from_json`` and repeats those in
each pushed-down filter, so one payload is parsed many times. A generator is evaluated once per
row and filters stay above it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from telemill.schema import ANY_OBJECT, EVENT, EVENT_TEXT


def decode_payload(records: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Broker value as text plus arrival time; ``carry`` names further columns to keep."""
    return records.select(
        F.col("value").cast("string").alias("json_payload"),
        F.col("timestamp").alias("kafka_timestamp"),
        *carry,
    )


def parse_json(decoded: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """Add the payload as one typed struct column ``event``."""
    return decoded.withColumn("event", F.from_json("json_payload", schema))


def flatten_event(decoded: DataFrame, schema: StructType = EVENT) -> DataFrame:
    """Payload fields as columns, next to everything that was there; one JSON parse per row."""
    return decoded.select("*", F.inline(F.array(F.from_json("json_payload", schema))))


def flatten_event_text(decoded: DataFrame) -> DataFrame:
    """Like ``flatten_event`` with every field as text."""
    return flatten_event(decoded, EVENT_TEXT)


def is_malformed() -> Column:
    """True when ``json_payload`` is not a JSON object. Needs the flattened fields.

    A row with any parsed field is an object for certain, so only rows without one are parsed a
    second time. ``when`` (not ``&``) keeps the second parse conditional.
    """
    nothing_parsed = reduce(and_, [F.col(f).isNull() for f in EVENT.fieldNames()])
    return F.when(nothing_parsed, F.from_json("json_payload", ANY_OBJECT).isNull()).otherwise(F.lit(False))


def flatten_event_object(decoded: DataFrame, always: bool = False) -> DataFrame:
    """``flatten_event_text`` with the whole object as a map of texts, ``_object``.

    It is needed only to tell what a field that is null means, so rows without one have no
    ``_object`` unless ``always``. The generator evaluates the parse once for everything above it.
    """
    some_null = reduce(or_, [F.col(f).isNull() for f in EVENT.fieldNames()])
    parsed = F.from_json("json_payload", ANY_OBJECT)
    whole = parsed if always else F.when(some_null, parsed)
    return flatten_event_text(decoded).select("*", F.explode(F.array(whole)).alias("_object"))


def is_no_object() -> Column:
    """``is_malformed`` for frames of ``flatten_event_object``."""
    nothing_parsed = reduce(and_, [F.col(f).isNull() for f in EVENT.fieldNames()])
    return nothing_parsed & F.col("_object").isNull()


def lacks_field(name: str) -> Column:
    """True when the payload has no such key (a key holding null is not lacking). Needs ``_object``."""
    return F.when(F.col(name).isNull(), ~F.map_contains_key("_object", F.lit(name))).otherwise(F.lit(False))
