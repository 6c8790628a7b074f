"""Derived values of one incident."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import col, contains_any, first_match


def is_active(state: Column | str, active=fixed.ACTIVE_STATES) -> Column:
    return F.coalesce(col(state).isin(*active), F.lit(False))


def is_high_impact(priority: Column | str, labels=fixed.HIGH_IMPACT_LABELS) -> Column:
    return contains_any(col(priority), labels)


def pattern_category(
    short_description: Column | str, rules=fixed.CATEGORY_WORDS, other=fixed.OTHER_CATEGORY
) -> Column:
    """Category of the first rule with a word in the text."""
    text = F.lower(col(short_description))
    cases = [(contains_any(text, words), F.lit(category)) for category, words in rules]
    return first_match(cases, F.lit(other))


def sla_breach(
    hours: Column | str,
    high_impact: Column | str,
    high_limit=fixed.SLA_HOURS_HIGH,
    normal_limit=fixed.SLA_HOURS_NORMAL,
) -> Column:
    """True where the hours exceed the limit; false while they are unknown."""
    limit = F.when(col(high_impact), F.lit(high_limit)).otherwise(F.lit(normal_limit))
    return F.coalesce(col(hours) > limit, F.lit(False))


def user_impact_estimate(
    number: Column | str, ci_type: Column | str, bands=fixed.USER_BANDS
) -> Column:
    """Users affected, drawn from the band of the CI type.

    The draw comes from the incident number, so a rerun or a retried task gives the
    same value.
    """
    draw = F.conv(F.substring(F.md5(col(number).cast("binary")), 1, 8), 16, 10).cast("bigint")
    kind = F.lower(col(ci_type))

    def users(low: int, high: int) -> Column:
        return (F.lit(low) + F.pmod(draw, F.lit(high - low))).cast("int")

    cases = [(contains_any(kind, words), users(low, high)) for words, low, high in bands if words]
    _, low, high = bands[-1]
    return first_match(cases, users(low, high))


def priority_digit(priority: Column | str) -> Column:
    """Leading digit of a priority label such as ``2 - High``."""
    return F.substring(col(priority), 1, 1).try_cast("int")


def priority_score(priority: Column | str) -> Column:
    """10 for priority 1, two less for each step down, NULL without a digit."""
    return F.lit(10) - F.lit(2) * (priority_digit(priority) - F.lit(1))


def location_parts(location: Column | str) -> Column:
    """Struct of a site text ``code - city - country / building``."""
    c = col(location)
    rest = F.split_part(c, F.lit(" - "), F.lit(3))
    return F.struct(
        F.split_part(c, F.lit(" - "), F.lit(1)).alias("site_code"),
        F.split_part(c, F.lit(" - "), F.lit(2)).alias("city"),
        F.split_part(rest, F.lit(" / "), F.lit(1)).alias("country"),
        F.split_part(rest, F.lit(" / "), F.lit(2)).alias("building"),
    )
