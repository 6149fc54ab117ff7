"""Column functions for event time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The numeric offset a record must carry in the strict path, unless it ends in Z.
OFFSET = r"[+-][0-9]{2}:[0-9]{2}\z"
# Without a date a bare time of day would be read as a time of *today*.
_HAS_DATE = r"\A\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
# date, time, fraction, offset of an ISO-8601 text
_ISO = (
    r"\A([0-9]{4}-[0-9]{2}-[0-9]{2})"
    r"(?:[T ]([0-9]{2}:[0-9]{2})(:[0-9]{2})?(?:[.,]([0-9]+))?"
    r"(Z|[+-][0-9]{2}(?::?[0-9]{2})?)?)?\z"
)


def event_time(c: Column) -> Column:
    """ISO-8601 text to an instant; null (never an error) when it is not one."""
    return F.when(c.rlike(_HAS_DATE), F.try_to_timestamp(c))


def has_offset(c: Column) -> Column:
    return c.endswith("Z") | c.rlike(OFFSET)


def is_iso(c: Column) -> Column:
    """True for a full ISO-8601 date or date-time that denotes a real moment."""
    return F.coalesce(c.rlike(_ISO) & F.try_to_timestamp(c).isNotNull(), F.lit(False))


def iso_has_zone(c: Column) -> Column:
    """True when an ISO-8601 date-time names its offset in any accepted form."""
    return F.regexp_extract(c, _ISO, 5) != ""


def iso_canonical(c: Column) -> Column:
    """Re-write ISO-8601 text in one form: seconds always, micros only if set, ``Z`` as ``+00:00``.

    The record's own offset is kept. Null when the text is not a moment.
    """

    def part(i: int) -> Column:
        return F.regexp_extract(c, _ISO, i)

    clock = F.when(part(2) == "", F.lit("00:00")).otherwise(part(2))
    seconds = F.when(part(3) == "", F.lit(":00")).otherwise(part(3))
    micros = F.rpad(part(4), 6, "0")
    fraction = F.when(micros.rlike(r"\A0*\z"), F.lit("")).otherwise(F.concat(F.lit("."), micros))
    digits = F.regexp_replace(part(5), ":", "")
    offset = (
        F.when(part(5) == "", F.lit(""))
        .when(part(5) == "Z", F.lit("+00:00"))
        .otherwise(F.concat(F.substring(digits, 1, 3), F.lit(":"), F.rpad(F.substring(digits, 4, 2), 2, "0")))
    )
    return F.when(is_iso(c), F.concat(part(1), F.lit("T"), clock, seconds, fraction, offset))


def as_text(c: Column) -> Column:
    """Timestamp as the text form query results are served in."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")


def as_iso(c: Column) -> Column:
    """Window start as ISO text with a numeric offset (the session runs in UTC)."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ssxxx")
