"""Timestamps, durations and their text form.

Timestamps are naive (``timestamp_ntz``) and mean UTC where a text names a zone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

MICROS_PER_SECOND = 1_000_000.0
SECONDS_PER_HOUR = 3600.0

# Multiplier that splits a double into two halves of 26 bits each.
_HALVES = 134217729.0


def to_timestamp(value: Column | str, formats: Sequence[str] = ()) -> Column:
    """Naive timestamp from text or a timestamp; NULL where the text is no timestamp.

    Text with a zone offset is brought to UTC, which is the session's zone. ``formats`` are
    further patterns, tried in order where the text is not in ISO form.
    """
    naive = col(value).try_cast("timestamp_ntz")
    read = F.when(naive.isNotNull(), col(value).try_cast("timestamp").cast("timestamp_ntz"))
    others = [F.try_to_timestamp(col(value).cast("string"), F.lit(x)).cast("timestamp_ntz") for x in formats]
    return F.coalesce(read, *others) if others else read


def timestamp_text(value: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(col(value), "yyyy-MM-dd HH:mm:ss")


def micros_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", col(start), col(end))


def hours_of_micros(micros: Column) -> Column:
    return micros.cast("double") / MICROS_PER_SECOND / SECONDS_PER_HOUR


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Hours from start to end, negative if end is earlier, NULL if one is missing."""
    return hours_of_micros(micros_between(start, end))


def iso_week(value: Column | str) -> Column:
    """ISO week number, 1 to 53."""
    return F.weekofyear(col(value))


def one_decimal(value: Column | str) -> Column:
    """Text with one decimal, rounded from the exact binary value, ties to even.

    Spark's own rounding starts from the shortest decimal form and takes 0.35 (stored
    as slightly less) up to 0.4. Here the distance to the rounding point is computed
    without error, by splitting the value so that both products by 20 are exact.
    """
    v = col(value)
    size = F.abs(v)
    tenths = F.floor(size * 10.0)
    scaled = size * _HALVES
    upper = scaled - (scaled - size)
    lower = size - upper
    gap = (upper * 20.0 - (tenths * 2 + 1).cast("double")) + lower * 20.0
    round_up = (gap > 0) | ((gap == 0) & (tenths % 2 == 1))
    rounded = tenths + F.when(round_up, 1).otherwise(0)
    sign = F.when(v < 0, F.lit("-")).otherwise(F.lit(""))
    return F.concat(
        sign, F.floor(rounded / 10).cast("string"), F.lit("."), (rounded % 10).cast("string")
    )
