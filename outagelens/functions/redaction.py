"""Masking of personal data in text, and hashing of identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed_values as fixed
from .text import col

PATTERNS = {name: pattern for name, pattern, _ in fixed.REDACTION_STEPS}


# Characters a match can start with, tested before the costlier word boundary.
_FIRST = {"phone": "(?=[+(0-9])", "ssn": r"(?=\d)", "ip": "(?=[0-9])", "name": "(?=[A-Z])"}


def unicode_words(pattern: str, step: str) -> str:
    """The pattern with word boundaries that know all letters, not only ASCII ones."""
    return "(?U)" + _FIRST.get(step, "") + pattern


def redact_step(text: Column | str, step: str) -> Column:
    """One masking step, by name."""
    for name, pattern, mask in fixed.REDACTION_STEPS:
        if name == step:
            masked = F.regexp_replace(col(text), F.lit(unicode_words(pattern, name)), F.lit(mask))
            if name == "email":
                return F.when(col(text).contains("@"), masked).otherwise(col(text))
            return masked
    raise ValueError(f"Unknown redaction step: {step}")


def redact_text(text: Column | str) -> Column:
    """All masking steps in order, as one nested expression. NULL stays NULL."""
    masked = col(text)
    for name, _, _ in fixed.REDACTION_STEPS:
        masked = redact_step(masked, name)
    return masked


def count_hits(text: Column | str, step: str) -> Column:
    """How often the pattern of a step occurs in the text; 0 on NULL."""
    hits = F.regexp_count(col(text), F.lit(unicode_words(PATTERNS[step], step)))
    if step == "email":
        hits = F.when(col(text).contains("@"), hits)
    return F.coalesce(hits, F.lit(0))


def hash_id(identifier: Column | str, salt: str) -> Column:
    """``HASH_`` and 12 hex digits of the salted SHA-256.

    The salt has no default: pass the one of earlier exports to keep their hashes.
    """
    c = col(identifier).cast("string")
    digest = F.sha2(F.concat(F.lit(salt + "_"), c), 256)
    hashed = F.concat(F.lit("HASH_"), F.upper(F.substring(digest, 1, 12)))
    return F.when(F.lower(c).isin(*fixed.BLANK_TEXTS), c).otherwise(hashed)


def location_country(location: Column | str) -> Column:
    """Text after the last `` - ``, up to `` / ``."""
    last = F.element_at(F.split(col(location), " - "), -1)
    return F.split_part(last, F.lit(" / "), F.lit(1))


def location_prefix(location: Column | str) -> Column:
    """Text before the first ``-``."""
    return F.split_part(col(location), F.lit("-"), F.lit(1))
