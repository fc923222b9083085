"""Numbers and text: lenient parsing, units, logs, sentinels and labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Missing-value marker in text columns and the word put in its place.
MISSING_MARKER = r"\N"
MISSING_WORD = "Unespecified"
MISSING_KEY_TEXT = "nan"


def to_number(value: Column) -> Column:
    """Text or number to double; unreadable values and NaN become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def metres_to_km(metres: Column) -> Column:
    return metres / F.lit(1000)


def stored_km(metres: Column) -> Column:
    """Kilometres as the dispatch table stores them, three decimals, halves away from zero."""
    return metres_to_km(metres).cast("decimal(10,3)")


def log1p_or_null(value: Column) -> Column:
    """ln(1+x), NULL at and below -1 so that no NaN or infinity gets in."""
    return F.when(value > -1, F.log1p(value))


def missing_flag(value: Column) -> Column:
    return value.isNull().cast("int")


def replace_marker(value: Column, word: str = MISSING_WORD) -> Column:
    return F.when(value == MISSING_MARKER, F.lit(word)).otherwise(value)


def text_key(*parts: Column) -> Column:
    """Parts joined by ``_``; a missing part contributes text, so the row keeps a key."""
    return F.concat_ws(
        "_", *[F.coalesce(part.cast("string"), F.lit(MISSING_KEY_TEXT)) for part in parts]
    )


def title_label(value: Column, joiner: str = " ") -> Column:
    """``pickup_distance`` as ``Pickup Distance`` (or with another joiner)."""
    words = F.transform(F.split(value, "_"), lambda word: F.initcap(word))
    return F.array_join(words, joiner)


def display_number(value: Column, digits: int = 1) -> Column:
    return F.round(value, digits)


def any_null(*columns: Column) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns])
