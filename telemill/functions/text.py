"""Column functions that clean identifiers and codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from telemill.config import DEFAULT_RULES, NO_FAULT, RuleSet

# What counts as white space at the ends of a text (fixed values: every Unicode white space
# character and the four ASCII separators).
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove every kind of white space at both ends (plain ``trim`` only removes blanks)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def _underscored(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit("_"))


def vehicle_id(c: Column, lenient: bool = False) -> Column:
    """Canonical upper-case id."""
    return F.upper(strip(c) if lenient else F.trim(c))


def fault_code(c: Column) -> Column:
    """Canonical code of the strict path: trimmed, upper case, ``-`` as ``_``."""
    return F.upper(_underscored(F.trim(c)))


def fault_code_alias(c: Column, rules: RuleSet = DEFAULT_RULES) -> Column:
    """Canonical code of the lenient path: run-together spellings are known, null is no fault.

    A code nobody knows passes through in canonical spelling.
    """
    code = _underscored(F.upper(strip(c)))
    known = F.create_map(*[F.lit(x) for pair in rules.fault_aliases.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(code)), code, F.lit(NO_FAULT))
