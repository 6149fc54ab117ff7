"""Whole flows in batch form, composed from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from telemill.config import DEFAULT_RULES, DEFAULT_WINDOW, RuleSet
from telemill.functions import text
from telemill.operators.changelog import latest_window_state, update_changelog
from telemill.operators.dedup import exact_dedup
from telemill.operators.validate import dead_letter, flag_events, valid_events, validate_rules, validate_split
from telemill.operators.windows import batch_window_kpis, deduplicated_measures, window_kpis_rounded


def ingest(
    records: DataFrame, arrival: str, window_duration: str = DEFAULT_WINDOW, rules: RuleSet = DEFAULT_RULES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(flagged, dead letters, window KPIs)`` of broker records at rest.

    ``arrival`` names a column of the records that orders arrivals (such as the offset).
    """
    flagged = flag_events(records, rules, carry=[arrival])
    windows = batch_window_kpis(valid_events(flagged, [arrival]), arrival, window_duration)
    return flagged, dead_letter(flagged), windows


def changelog(
    records: DataFrame,
    arrival: str,
    batch: str = "batch_id",
    window_duration: str = DEFAULT_WINDOW,
    rules: RuleSet = DEFAULT_RULES,
) -> DataFrame:
    """Changelog the streaming job would have written, had the records come in these batches."""
    flagged = flag_events(records, rules, carry=[arrival, batch])
    narrow = valid_events(flagged, [arrival, batch])
    first = deduplicated_measures(narrow, arrival, extra=[batch])
    return update_changelog(first, window_duration, batch, F.col("fault"))


def state(
    records: DataFrame, arrival: str, batch: str = "batch_id", window_duration: str = DEFAULT_WINDOW
) -> DataFrame:
    """Compacted state of that changelog."""
    return latest_window_state(changelog(records, arrival, batch, window_duration))


def rule_checked_summaries(
    records: DataFrame, window_seconds: int = 300, rules: RuleSet = DEFAULT_RULES
) -> DataFrame:
    """Rule-level validation, whole-record dedup, canonical codes, rounded window summaries.

    Records are the same if all their keys and values are, also those no column is made of.
    """
    valid, _, _ = validate_split(validate_rules(records, rules, extra=True), carry=["extra"])
    clean = exact_dedup(valid).withColumns(
        {
            "vehicle_id": text.vehicle_id(F.col("vehicle_id"), lenient=True),
            "fault_code": text.fault_code_alias(F.col("fault_code"), rules),
        }
    )
    return window_kpis_rounded(clean, window_seconds)
