"""Redaction of whole tables and the check that nothing was left."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import fixed_values as fixed
from ..functions import redaction as red


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, StringType)]


def redact_frame(
    df: DataFrame,
    salt: str,
    text: Sequence[str] = fixed.TEXT_COLUMNS,
    ids: Sequence[str] = fixed.ID_COLUMNS,
    drop: Sequence[str] = fixed.DROP_COLUMNS,
    drop_raw_ids: bool = False,
) -> DataFrame:
    """Mask text columns, add ``<id>_hash`` columns, drop sensitive columns.

    The raw identifiers stay unless ``drop_raw_ids`` is set.
    """
    hashed = [name for name in ids if name in df.columns and name not in drop]
    changes = {name: red.redact_text(name) for name in text if name in df.columns}
    changes |= {f"{name}_hash": red.hash_id(name, salt) for name in hashed}
    return df.withColumns(changes).drop(*drop, *(hashed if drop_raw_ids else ()))


def redact_live_export(df: DataFrame, salt: str) -> DataFrame:
    """Redaction of a live export: of the location only the country is kept."""
    rows = redact_frame(
        df,
        salt,
        text=("short_description", "description", "work_notes"),
        ids=("number",),
        drop=("caller_id", "assigned_to"),
    )
    if "location" not in rows.columns:
        return rows
    return rows.withColumn("location", red.location_country("location"))


def redact_replace_id(df: DataFrame, salt: str) -> DataFrame:
    """Variant for sharing: ``id_hash`` takes the place of the number."""
    has = df.columns.__contains__
    changes = {}
    if has("number"):
        changes["id_hash"] = red.hash_id("number", salt)
    for name in ("short_description", "description"):
        if has(name):
            changes[name] = red.redact_text(name)
    if has("location"):
        changes["location"] = red.location_prefix("location")
    return df.withColumns(changes).drop("number", "caller_id")


def _total_hits(df: DataFrame, step: str) -> Column:
    hits = [red.count_hits(name, step) for name in text_columns(df)]
    per_row = reduce(Column.__add__, hits, F.lit(0))
    return F.coalesce(F.sum(per_row), F.lit(0).cast("bigint"))


STEPS = ("email", "phone")


def _hit_counts(df: DataFrame, suffix: str) -> list[Column]:
    return [_total_hits(df, step).alias(f"{step}_count_{suffix}") for step in STEPS]


def _with_verdict(counts: DataFrame) -> DataFrame:
    clean = (F.col("email_count_redacted") == 0) & (F.col("phone_count_redacted") == 0)
    return counts.withColumn("redaction_successful", clean)


def validate_redaction(original: DataFrame, redacted: DataFrame) -> DataFrame:
    """One row: emails and phones before and after, and whether none is left.

    Hits are counted in each value, one aggregate per table. For tables that are stored; a run
    that writes the redacted table counts them on the way, see `ObservedRedaction`.
    """
    before = original.agg(*_hit_counts(original, "original"))
    after = redacted.agg(*_hit_counts(redacted, "redacted"))
    names = [*before.columns, *after.columns]
    one_row = before.select(
        "*", *[F.lit(None).cast("bigint").alias(name) for name in after.columns]
    ).unionByName(
        after.select("*", *[F.lit(None).cast("bigint").alias(name) for name in before.columns])
    ).agg(*[F.max(name).alias(name) for name in names])
    return _with_verdict(one_row)


class ObservedRedaction:
    """The same check, counted while the redacted table is written.

    ``original`` and ``redacted`` return the tables to go on with; after the write ``check``
    gives the row without reading either again. Redaction is row work, so each row counts once.
    """

    def __init__(self, spark: SparkSession):
        self._spark = spark
        self._before, self._after = Observation(), Observation()

    def original(self, df: DataFrame) -> DataFrame:
        return df.observe(self._before, *_hit_counts(df, "original"))

    def redacted(self, df: DataFrame) -> DataFrame:
        return df.observe(self._after, *_hit_counts(df, "redacted"))

    def check(self) -> DataFrame:
        found = {**self._before.get, **self._after.get}
        row = self._spark.createDataFrame([tuple(found.values())], ", ".join(f"{name} long" for name in found))
        return _with_verdict(row)


def pii_column_scan(df: DataFrame, words: Sequence[str] = fixed.PERSONAL_NAME_WORDS) -> DataFrame:
    """One row per column: sensitive by its name, and pattern hits in its values.

    A single aggregate over the table; its one row is then turned into rows.
    """
    texts = set(text_columns(df))
    aggregates = []
    entries = []
    for position, name in enumerate(df.columns):
        counted = []
        for step in ("email", "phone"):
            alias = f"{step}_{position}"
            hits = red.count_hits(name, step) if name in texts else F.lit(0)
            aggregates.append(F.coalesce(F.sum(hits), F.lit(0).cast("bigint")).alias(alias))
            counted.append(F.col(alias).alias(f"{step}_hits"))
        by_name = any(word in name.lower() for word in words)
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(by_name).alias("sensitive_by_name"),
                *counted,
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))
