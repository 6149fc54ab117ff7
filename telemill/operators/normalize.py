"""The lenient normaliser: coerces instead of rejecting, and flags what it cannot coerce."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from telemill.config import DEFAULT_RULES, MEASURES, REQUIRED_FIELDS, RuleSet
from telemill.functions import numbers, text, times
from telemill.operators.decode import lacks_field
from telemill.operators.dedup import last_entries
from telemill.operators.validate import text_events


def coerce_numeric(name: str) -> Column:
    """Measure of a text event as double: an absent key is 0, null or non-numeric text is null."""
    return F.when(lacks_field(name), F.lit(0.0)).otherwise(numbers.numeric(F.col(name)))


def normalize_events(
    records: DataFrame, rules: RuleSet = DEFAULT_RULES, carry: Sequence[str] = (), extra: bool = False
) -> DataFrame:
    """Canonical form of every record that is a JSON object.

    ``timestamp`` keeps the record's own offset. ``normalize_error`` names what made a record
    impossible to normalise (null when fine); such rows stay in the result. With ``extra`` the
    payload's other keys are kept as a map of texts.
    """
    events = text_events(records, carry, whole=extra).filter(~F.col("is_malformed"))
    others = F.filter(last_entries("_object"), lambda e: ~e["key"].isin(*REQUIRED_FIELDS))
    clean = events.select(
        F.coalesce(text.vehicle_id(F.col("vehicle_id"), lenient=True), F.lit("")).alias("vehicle_id"),
        times.iso_canonical(text.strip(F.col("timestamp"))).alias("timestamp"),
        *[coerce_numeric(m).alias(m) for m in MEASURES],
        text.fault_code_alias(F.col("fault_code"), rules).alias("fault_code"),
        *([F.map_from_entries(others).alias("extra")] if extra else []),
        *carry,
    )
    problem = F.coalesce(
        F.when(F.col("timestamp").isNull(), F.lit("timestamp")),
        *[F.when(F.col(m).isNull(), F.lit(m)) for m in MEASURES],
    )
    return clean.withColumn("normalize_error", problem)
