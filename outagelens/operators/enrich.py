"""Standard column names, defaults and the derived columns of the incident table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fixed
from ..functions import incident as inc
from ..functions import times


def rename_standard(
    df: DataFrame, names: Mapping[str, Sequence[str]] = fixed.STANDARD_NAMES
) -> DataFrame:
    """Give export columns their standard name, unless that name is already taken."""
    renames = {}
    for standard, exported in names.items():
        found = [name for name in exported if name in df.columns]
        if found and standard not in df.columns:
            renames[found[0]] = standard
    return df.withColumnsRenamed(renames)


def fill_defaults(df: DataFrame, defaults: Mapping = fixed.COLUMN_DEFAULTS) -> DataFrame:
    """Add absent columns with their default."""
    missing = {name: F.lit(value) for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing)


def coerce_timestamps(
    df: DataFrame,
    columns: Sequence[str] = ("openedDate", "resolvedDate"),
    formats: Sequence[str] = (),
) -> DataFrame:
    """Turn the columns into naive timestamps; text that is none becomes NULL.

    ``formats`` are patterns besides the ISO form, such as ``dd/MM/yyyy HH:mm``.
    """
    return df.withColumns(
        {name: times.to_timestamp(name, formats) for name in columns if name in df.columns}
    )


def unread_timestamps(
    df: DataFrame,
    columns: Sequence[str] = ("openedDate", "resolvedDate"),
    formats: Sequence[str] = (),
) -> DataFrame:
    """One row: for each column how many texts are no timestamp in any known form."""
    there = [name for name in columns if name in df.columns]
    unread = {
        name: (F.trim(F.col(name).cast("string")) != "") & times.to_timestamp(name, formats).isNull() for name in there
    }
    return df.agg(*[F.count_if(condition).alias(name) for name, condition in unread.items()])


def enrich_incidents(df: DataFrame) -> DataFrame:
    """The incident table with its seven derived columns.

    One projection, no shuffle: it keeps the partitioning of its input.
    """
    rows = coerce_timestamps(rename_standard(df))
    has = rows.columns.__contains__
    nothing = F.lit(None).cast("string")
    priority = F.col("priority") if has("priority") else nothing
    text = F.col("short_description") if has("short_description") else nothing
    ci_type = F.col("ci_type") if has("ci_type") else nothing
    # Only repeatable estimates need a key; without a number the whole row serves.
    whole_row = F.concat_ws("|", *[F.col(name).cast("string") for name in rows.columns])
    key = F.coalesce("number", whole_row) if has("number") else whole_row
    both_dates = has("openedDate") and has("resolvedDate")
    rows = rows.withColumns(
        {
            "isActive": inc.is_active("state"),
            "isHighImpact": inc.is_high_impact(priority),
            "patternCategory": inc.pattern_category(text),
            "resolutionTimeHrs": times.hours_between("openedDate", "resolvedDate")
            if both_dates
            else F.lit(None).cast("double"),
            "userImpactEstimate": inc.user_impact_estimate(key, ci_type),
            "week": times.iso_week("openedDate")
            if has("openedDate")
            else F.lit(None).cast("int"),
        }
    )
    return rows.withColumn("slaBreach", inc.sla_breach("resolutionTimeHrs", "isHighImpact"))
