"""Text to numbers with a strict grammar, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The accepted spellings of unsigned integers and of floating-point numbers.
UNSIGNED = r"^\+?[0-9]+$"
REAL = r"^[+-]?(inf|infinity|nan|([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?)$"


def trimmed(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def parse_id(text: Column) -> Column:
    """An unsigned id as a long; null if it isn't one or exceeds a long."""
    value = trimmed(text)
    return F.when(value.rlike(UNSIGNED), value.try_cast("bigint"))


def parse_real(text: Column, kind: str = "double") -> Column:
    """A floating-point number of ``kind``; null if the text isn't one. Hex, suffixes and blanks inside don't count."""
    value = F.lower(trimmed(text))
    spelt = F.regexp_replace(value, "^[+-]nan$", "nan")
    return F.when(value.rlike(REAL), spelt.try_cast(kind))
