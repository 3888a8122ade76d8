"""Casts that turn bad text into NULL whatever the ANSI setting of the session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal notation without exponent, blanks around it allowed: the sign and the integer digits
# are kept, a fraction is cut off.
_DECIMAL_TEXT = r"^[\s\p{Cntrl}]*(?<sign>[+-]?)(?=[\d.])(?<digits>\d*)(?:\.\d*)?[\s\p{Cntrl}]*$"


def lenient_int(text: Column) -> Column:
    """Text to INT: '85' and '85.5' give 85; words, exponents and overflow give NULL.

    Plain integers take the first cast only; the pattern runs for the rest.
    """
    digits = F.regexp_replace(text, _DECIMAL_TEXT, "${sign}0${digits}")
    return F.coalesce(text.try_cast("int"), digits.try_cast("int"))


def whole_number(value: Column) -> Column:
    """A number or its text to INT where it is whole: 12.0, '12.0' and '1e2' are; a fraction, a word
    and what INT cannot hold give NULL."""
    number = value.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))


def lenient_timestamp(text: Column) -> Column:
    """ISO text to TIMESTAMP, offsets honoured; anything else gives NULL."""
    return F.try_to_timestamp(text)
