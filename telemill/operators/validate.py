"""Validation: strict verdict with dead-letter routing, and rule-level messages.

Both kinds work on ONE flagged frame, so valid and rejected rows are complements by construction
and a caller that needs both reads the source once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from telemill.config import DEFAULT_RULES, INVALID, MALFORMED, MEASURES, REQUIRED_FIELDS, RuleSet
from telemill.functions import numbers, text, times
from telemill.operators.dedup import last_entries
from telemill.operators.decode import decode_payload, flatten_event, flatten_event_object, is_malformed, is_no_object, lacks_field

VALID_COLUMNS = (
    "vehicle_id",
    "timestamp",
    "speed",
    "battery_level",
    "temperature",
    "fault_code",
    "json_payload",
    "kafka_timestamp",
    "event_timestamp",
)


# --- strict path ---------------------------------------------------------------------------


def normalize(events: DataFrame) -> DataFrame:
    """Canonical id and code, and the event time as an instant."""
    return events.withColumns(
        {
            "vehicle_id": text.vehicle_id(F.col("vehicle_id")),
            "fault_code": text.fault_code(F.col("fault_code")),
            "event_timestamp": times.event_time(F.col("timestamp")),
        }
    )


def passes(rules: RuleSet = DEFAULT_RULES) -> Column:
    """All strict rules as one never-null boolean."""
    checks = [
        F.col("vehicle_id").rlike(rules.id_pattern),
        F.col("event_timestamp").isNotNull(),
        times.has_offset(F.col("timestamp")),
        *[F.col(name).between(*rules.limits[name]) for name in MEASURES],
        F.col("fault_code").isin(*rules.fault_codes),
    ]
    return F.coalesce(reduce(and_, checks), F.lit(False))


def flag_events(
    records: DataFrame,
    rules: RuleSet = DEFAULT_RULES,
    carry: Sequence[str] = (),
    compat: bool = False,
) -> DataFrame:
    """Decode, parse, normalise and judge broker records, one output row per record.

    Adds ``is_valid`` and ``error_reason`` (null when valid). With ``compat`` only an empty or
    absent payload counts as malformed and other unreadable text as invalid values.
    """
    events = flatten_event(decode_payload(records, carry))
    if compat:
        malformed = F.coalesce(F.col("json_payload").rlike(r"\A\s*\z"), F.lit(True))
    else:
        malformed = is_malformed()
    ok = passes(rules)
    reason = F.when(~ok, F.when(malformed, MALFORMED).otherwise(INVALID))
    return normalize(events).withColumns({"is_valid": ok, "error_reason": reason})


def valid_events(flagged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return flagged.filter("is_valid").select(*VALID_COLUMNS, *carry)


def dead_letter(flagged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Every rejected record with its reason."""
    return flagged.filter(~F.col("is_valid")).select("json_payload", "error_reason", "kafka_timestamp", *carry)


def malformed_events(flagged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return dead_letter(flagged, carry).filter(F.col("error_reason") == MALFORMED)


def invalid_events(flagged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return dead_letter(flagged, carry).filter(F.col("error_reason") == INVALID)


def invalid_counts(flagged: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rejected rows per micro-batch."""
    return flagged.filter(~F.col("is_valid")).groupBy(batch).agg(F.count(F.lit(1)).alias("invalid_records"))


# --- rule-level messages (lenient path) ----------------------------------------------------


def text_events(records: DataFrame, carry: Sequence[str] = (), whole: bool = False) -> DataFrame:
    """Payload fields as text, ``is_malformed``, and ``_object`` (see ``flatten_event_object``)."""
    events = flatten_event_object(decode_payload(records, carry), always=whole)
    return events.withColumn("is_malformed", is_no_object())


def light_trim(events: DataFrame) -> DataFrame:
    """Strip id and code; case stays. A record without an id gets an empty one."""
    return events.withColumns(
        {
            "vehicle_id": F.coalesce(text.strip(F.col("vehicle_id")), F.lit("")),
            "fault_code": text.strip(F.col("fault_code")),
        }
    )


def missing_fields() -> Column:
    """Names of the required keys the payload lacks, in declared order; the id never counts."""
    names = [f for f in REQUIRED_FIELDS if f != "vehicle_id"]
    some_null = reduce(or_, [F.col(f).isNull() for f in names])
    absent = F.array_compact(F.array(*[F.when(lacks_field(f), F.lit(f)) for f in names]))
    return F.when(some_null, absent).otherwise(_none())


def _none() -> Column:
    """Empty list of texts."""
    return F.array().cast("array<string>")


def _read(events: DataFrame) -> DataFrame:
    """Add what the rules look at, so that each text is interpreted once per row."""
    stamp = F.coalesce(F.col("timestamp"), F.lit(""))
    return events.withColumns(
        {
            **{f"_{m}": numbers.numeric(F.col(m)) for m in MEASURES},
            "_iso": times.is_iso(stamp),
            "_zone": times.iso_has_zone(stamp),
            "_absent": missing_fields(),
        }
    )


def _range_message(name: str, rules: RuleSet) -> Column:
    low, high = rules.limits[name]
    value = F.col(f"_{name}")
    return F.when(value.isNull(), F.lit(f"{name} is not numeric")).when(
        ~value.between(low, high), F.lit(f"{name} is out of expected range {low}..{high}")
    )


def validation_errors(rules: RuleSet = DEFAULT_RULES) -> Column:
    """Ordered messages for a trimmed text event that went through ``_read``; empty when it passes.

    Missing keys are reported alone. A payload that is no object at all gets one message.
    """
    messages = [
        F.when(F.col("vehicle_id") == "", "vehicle_id is null or empty").when(
            ~F.col("vehicle_id").rlike(rules.id_pattern_any_case), "vehicle_id has an invalid format"
        ),
        F.when(~F.col("_iso"), "timestamp is not a valid ISO-8601 datetime").when(
            ~F.col("_zone"), "timestamp must include timezone information"
        ),
        *[_range_message(name, rules) for name in MEASURES],
        F.when(
            ~F.coalesce(F.upper(F.col("fault_code")).isin(*rules.fault_codes), F.lit(False)),
            "fault_code is invalid",
        ),
    ]
    absent = F.transform("_absent", lambda f: F.concat(F.lit("Missing required field: "), f))
    return (
        F.when(F.col("is_malformed"), F.array(F.lit(MALFORMED)))
        .when(F.size("_absent") > 0, absent)
        # Most rows fail nothing; the list is only put together for those that do.
        .when(F.coalesce(*messages).isNull(), _none())
        .otherwise(F.array_compact(F.array(*messages)))
    )


def validate_rules(
    records: DataFrame, rules: RuleSet = DEFAULT_RULES, carry: Sequence[str] = (), extra: bool = False
) -> DataFrame:
    """One row per record with ``valid`` and the ordered ``errors``.

    Fields are trimmed text; measures are also there as numbers (``_speed`` and so on). With
    ``extra`` the payload's other keys follow as sorted entries in a column of that name.
    """
    # Exploding a one-element array pins `errors` to a single evaluation per row.
    read = _read(light_trim(text_events(records, carry, whole=extra)))
    if extra:
        others = F.filter(last_entries("_object"), lambda e: ~e["key"].isin(*REQUIRED_FIELDS))
        read = read.withColumn("extra", F.sort_array(others))
    judged = read.select("*", F.explode(F.array(validation_errors(rules))).alias("errors"))
    return judged.withColumn("valid", F.size("errors") == 0).drop("_iso", "_zone", "_absent", "_object")


def validate_split(judged: DataFrame, carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(valid typed events, invalid original payloads, one row per reason)``."""
    valid = judged.filter("valid").select(
        "vehicle_id",
        "timestamp",
        *[F.col(f"_{m}").alias(m) for m in MEASURES],
        "fault_code",
        *carry,
    )
    rejected = judged.filter(~F.col("valid"))
    invalid = rejected.select("json_payload", *carry)
    reasons = rejected.select(F.explode("errors").alias("reason"), *carry)
    return valid, invalid, reasons


def split_rows(judged: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The same three parts as one long frame ``(part, content)``, from a single pass: the id of a
    valid event, the original payload of an invalid one, and each of its reasons."""

    def row(part: str, content: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), content.alias("content"))

    rejected = F.concat(
        F.array(row("invalid", F.col("json_payload"))), F.transform("errors", lambda e: row("reason", e))
    )
    rows = F.when(F.col("valid"), F.array(row("valid", F.col("vehicle_id")))).otherwise(rejected)
    return judged.select(*carry, F.inline(rows))


def dq_reason_counts(judged: DataFrame) -> DataFrame:
    """How often each rule failed."""
    _, _, reasons = validate_split(judged)
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("occurrences"))
