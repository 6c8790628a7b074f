"""Declared schemas of the exports; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)


def _texts(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


# Fields asked for when incidents are pulled for root-cause work.
INCIDENT_FIELDS = (
    "sys_id", "number", "short_description", "description", "priority", "impact", "urgency",
    "state", "assignment_group", "assigned_to", "opened_at", "resolved_at", "closed_at",
    "caller_id", "location", "cmdb_ci", "category", "subcategory", "contact_type",
    "reassignment_count", "close_code", "close_notes", "resolution_code", "resolution_notes",
)
INCIDENT = StructType(_texts(*INCIDENT_FIELDS, "parent"))

# CSV export with standard names.
STANDARD_EXPORT = StructType(
    _texts(
        "number", "short_description", "description", "priority", "incident_state",
        "assignment_group", "opened", "resolved", "caller_id", "location", "ci_type",
    )
)

# CSV export with the names of a live instance.
LIVE_EXPORT = StructType(
    _texts("number")
    + [StructField("reassignment_count", IntegerType())]
    + _texts(
        "location", "assignment_group", "opened_at", "priority", "u_ci_type", "assigned_to",
        "short_description", "description", "work_notes", "incident_state", "caller_id",
        "u_resolved", "category", "cmdb_ci", "contact_type",
    )
)

JOURNAL = StructType(_texts("sys_created_on", "name", "value", "element_id", "element"))

PROBLEM = StructType(
    _texts("number", "short_description", "priority", "state", "opened_at", "resolved_at", "incidents")
)
CHANGE = StructType(
    _texts("number", "short_description", "priority", "state", "opened_at", "closed_at", "incidents")
)


def envelope(record: StructType) -> StructType:
    """Schema of a landed response: one object whose ``result`` lists the records."""
    return StructType([StructField("result", ArrayType(record))])


