"""Root cause, contributing factors, impact, duration and priority texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import (
    col,
    contains_any,
    display_value,
    first_match,
    first_text,
    safe_int,
    text_or,
)
from .times import one_decimal


def cause_from_notes(notes: Column | str, rules=fixed.CAUSE_WORDS) -> Column:
    """``title: first 200 characters`` by the first rule with a word in the notes."""
    text = col(notes)
    lowered = F.lower(text)
    start = F.substring(text, 1, 200)
    cases = [
        (contains_any(lowered, words), F.concat(F.lit(f"{title}: "), start))
        for title, words in rules
    ]
    return first_match(cases, F.lit(None).cast("string"))


def sentence_pieces(text: Column) -> Column:
    """What a stretch of lower-case text says about sentences with the cause phrase.

    ``closed``: the stretch holds a period. ``head``: text up to the first period (all of
    it if there is none). ``tail``: text after the last. ``hit``: the first whole sentence
    between the two that holds the phrase, without its period.
    """
    pieces = F.split(text, r"\.", -1)
    count = F.size(pieces)
    inner = F.slice(pieces, F.lit(2), F.greatest(count - F.lit(2), F.lit(0)))
    return F.struct(
        (count > 1).alias("closed"),
        F.element_at(pieces, 1).alias("head"),
        F.when(text.contains(fixed.CAUSE_PHRASE), first_with_phrase(inner)).alias("hit"),
        F.element_at(pieces, -1).alias("tail"),
    )


def reduced_text(pieces: Column) -> Column:
    """A text that says the same as the stretch about its neighbours and the first whole hit.

    ``sentence_pieces`` gives the same result for it, alone and joined with others.
    """
    hit = F.coalesce(F.concat(pieces["hit"], F.lit(".")), F.lit(""))
    whole = F.concat(pieces["head"], F.lit("."), hit, pieces["tail"])
    return F.when(pieces["closed"], whole).otherwise(pieces["head"])


def first_with_phrase(sentences: Column) -> Column:
    return F.get(F.filter(sentences, lambda s: s.contains(fixed.CAUSE_PHRASE)), F.lit(0))


def join_pieces(left: Column, right: Column) -> Column:
    """``sentence_pieces`` of two neighbouring stretches that are joined by a space.

    The operation is associative, so stretches can be merged level by level.
    """

    def spaced(a: Column, b: Column) -> Column:
        return F.concat(a, F.lit(" "), b)

    bridge = spaced(left["tail"], right["head"])
    bridge_hit = F.when(bridge.contains(fixed.CAUSE_PHRASE), bridge)
    both = left["closed"] & right["closed"]
    return F.struct(
        (left["closed"] | right["closed"]).alias("closed"),
        F.when(left["closed"], left["head"])
        .otherwise(spaced(left["head"], right["head"]))
        .alias("head"),
        F.coalesce(left["hit"], F.when(both, bridge_hit), right["hit"]).alias("hit"),
        F.when(right["closed"], right["tail"])
        .otherwise(spaced(left["tail"], right["tail"]))
        .alias("tail"),
    )


def sentence_of_pieces(pieces: Column) -> Column:
    """First sentence with the cause phrase and a closing period, stripped."""
    head_hit = F.when(
        pieces["closed"] & pieces["head"].contains(fixed.CAUSE_PHRASE), pieces["head"]
    )
    sentence = F.coalesce(head_hit, pieces["hit"])
    return F.concat(F.regexp_replace(sentence, r"(?U)^\s+", ""), F.lit("."))


def cause_sentence(text: Column | str) -> Column:
    """First sentence of a text that holds the cause phrase, in lower case."""
    return sentence_of_pieces(sentence_pieces(F.lower(col(text))))


def cause_from_problem(short_description: Column | str) -> Column:
    return F.concat(F.lit(fixed.PROBLEM_PREFIX), first_text(short_description))


def cause_from_description(description: Column | str, short_description: Column | str) -> Column:
    text = first_text(description, short_description)
    return F.coalesce(
        F.concat(F.lit(fixed.DESCRIPTION_PREFIX), F.substring(text, 1, 200)),
        F.lit(fixed.CAUSE_UNKNOWN),
    )


def contributing_factors(
    reassignments: Column | str, span_hours: Column | str, work_notes: Column | str
) -> Column:
    """List of factor texts; empty if none applies."""
    times = safe_int(reassignments)
    span = col(span_hours)
    return F.array_compact(
        F.array(
            F.when(times > 2, F.format_string(fixed.REASSIGNED_TEXT, times.cast("string"))),
            F.when(span > 24, F.format_string(fixed.EXTENDED_TEXT, one_decimal(span))),
            F.when(col(work_notes) > 5, F.lit(fixed.MANY_NOTES_TEXT)),
        )
    )


def _tier(priority, impact, rows, last) -> Column:
    """Value of the first row whose digit or word occurs, else ``last``."""
    digit_text = text_or(priority)
    word_text = F.lower(text_or(impact))
    cases = [
        (digit_text.contains(digit) | word_text.contains(word), F.lit(value))
        for digit, word, value in rows
    ]
    return first_match(cases, F.lit(last))


def business_impact(priority: Column | str, impact: Column | str) -> Column:
    rows = [(digit, word, text) for digit, word, text, _ in fixed.IMPACT_TIERS]
    return _tier(priority, impact, rows, fixed.LOWEST_IMPACT[0])


def default_users(priority: Column | str, impact: Column | str) -> Column:
    rows = [(digit, word, users) for digit, word, _, users in fixed.IMPACT_TIERS]
    return _tier(priority, impact, rows, fixed.LOWEST_IMPACT[1]).cast("bigint")


def technical_impact(cmdb_ci: Column | str, category: Column | str) -> Column:
    return F.concat(
        F.lit("Affected CI: "),
        display_value(cmdb_ci, "Unknown", keyless=""),
        F.lit(". Category: "),
        text_or(category),
    )


def affected_users(
    description: Column | str, short_description: Column | str, fallback: Column | str
) -> Column:
    """Number before ``users`` or ``people`` in a text that mentions users."""
    text = F.lower(first_text(description, short_description))
    found = F.nullif(
        F.regexp_extract(text, fixed.USER_COUNT_PATTERN, 1), F.lit("")
    ).try_cast("bigint")
    return F.coalesce(F.when(text.contains("user"), found), col(fallback))


def user_impact(users: Column | str) -> Column:
    return F.concat(F.lit("Estimated "), col(users).cast("string"), F.lit(" users affected"))


def resolution_efficiency(hours: Column | str) -> Column:
    """Tier text; empty while the hours are unknown."""
    h = col(hours)
    cases = [(h.isNull(), F.lit(""))]
    cases += [(h < bound, F.lit(text)) for bound, text in fixed.EFFICIENCY_TIERS]
    return first_match(cases, F.lit(fixed.LOWEST_EFFICIENCY))


def hours_text(hours: Column | str) -> Column:
    return F.concat(one_decimal(hours), F.lit(" hours"))


def priority_justification(
    priority: Column | str, impact: Column | str, urgency: Column | str
) -> Column:
    return F.concat_ws(
        "",
        F.lit("Priority: "),
        col(priority),
        F.concat(F.lit(", Impact: "), first_text(impact)),
        F.concat(F.lit(", Urgency: "), first_text(urgency)),
        _tier(priority, impact, fixed.PRIORITY_REASONS, fixed.STANDARD_REASON),
    )
