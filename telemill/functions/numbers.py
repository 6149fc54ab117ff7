"""Column functions for measures: coercion, rounding, rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemill.functions.text import strip

# Java also reads "1d", "1f" and hex as doubles; plain decimal text is what counts as numeric here.
_DECIMAL = r"(?i)\A\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?\s*\z"
# Read as text, a bare NaN token of the payload keeps quotes around it.
_SPECIAL = r'(?i)\A\s*"?(nan|[+-]?inf(?:inity)?)"?\s*\z'


def numeric(c: Column) -> Column:
    """Text to double; null when the text is not a decimal number."""
    special = F.when(c.rlike(_SPECIAL), F.regexp_extract(c, _SPECIAL, 1).try_cast("double"))
    return F.when(c.rlike(_DECIMAL), strip(c).try_cast("double")).otherwise(special)


def or_zero(c: Column) -> Column:
    """Result text to double, 0.0 when absent or unreadable."""
    return F.coalesce(numeric(c), F.lit(0.0))


def or_zero_int(c: Column) -> Column:
    """Result text to bigint by way of double (``"3.7"`` is 3), 0 when absent or unreadable."""
    return F.coalesce(numeric(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def round_to(c: Column, digits: int) -> Column:
    """Round half up on the decimal value.

    Going through DECIMAL(20,8) takes the noise of summation order out before a tie is decided;
    values too large for it are rounded as doubles.
    """
    exact = F.round(c.try_cast("decimal(20,8)"), digits).cast("double")
    return F.coalesce(exact, F.round(c, digits))


def round_2(c: Column) -> Column:
    return round_to(c, 2)


def fault_rate_pct(faults: Column, events: Column, digits: int = 2) -> Column:
    """Share of fault events in percent; null when there were no events."""
    return round_to(F.lit(100.0) * faults / F.nullif(events, F.lit(0)), digits)
