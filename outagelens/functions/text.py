"""Text helpers shared by the other Column builders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    """A Column from a Column or a column name."""
    return value if isinstance(value, Column) else F.col(value)


def text_or(value: Column | str, default: str = "") -> Column:
    """The text, or ``default`` where it is NULL."""
    return F.coalesce(col(value), F.lit(default))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """True where the text holds one of the words; false on NULL."""
    hits = [text.contains(word) for word in words]
    return F.coalesce(reduce(Column.__or__, hits), F.lit(False))


def first_match(cases: Iterable[tuple[Column, Column]], otherwise: Column) -> Column:
    """Value of the first case whose condition holds."""
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def first_text(*values: Column | str) -> Column:
    """The first value that is neither NULL nor empty, else NULL."""
    return F.coalesce(*[F.nullif(col(v), F.lit("")) for v in values])


def display_value(
    value: Column | str, default: str, keyless: str | None = None, empty: str | None = None
) -> Column:
    """The readable name held by a reference field.

    Exports hold such a field either as an object with a ``display_value`` key, kept as
    its JSON text, or as plain text. ``default`` stands in for NULL, ``keyless`` (equal
    to ``default`` unless given) for an object without the key, ``empty`` for ''.
    """
    c = col(value)
    name = F.coalesce(
        F.get_json_object(c, "$.display_value"), F.lit(default if keyless is None else keyless)
    )
    plain = F.coalesce(c if empty is None else F.when(c == "", F.lit(empty)).otherwise(c), F.lit(default))
    is_object = c.startswith("{") & F.get_json_object(c, "$").isNotNull()
    return F.when(is_object, name).otherwise(plain)


def safe_int(value: Column | str) -> Column:
    """Whole number from a number or text; 0 where there is none."""
    return F.coalesce(col(value).try_cast("bigint"), F.lit(0).cast("bigint"))


def join_lines(lines: Iterable[Column]) -> Column:
    """Lines joined by newline; NULL lines are left out."""
    return F.concat_ws("\n", *lines)
