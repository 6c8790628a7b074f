"""Incident, journal, problem and change tables derived from the driver's tables.

Every view reads whole tables. ``incidents`` joins only what the asked columns need:
all its joins are left joins on unique keys, so leaving one out changes no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from outagelens.sources.files import scan_parquet


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the file footer once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return scan_parquet(spark, path, _SCHEMAS[path])


def _number(key: str) -> Column:
    text = F.col(key).cast("string")
    return F.concat(F.lit("INC"), F.lpad(text, F.greatest(F.length(text), F.lit(7)), F.lit("0")))


def _sys_id(key: str) -> Column:
    return F.md5(_number(key).cast("binary"))


def _choice(index: Column, values: Sequence[str | None], otherwise: str | None = None) -> Column:
    chain = F
    for position, value in enumerate(values):
        chain = chain.when(index == position, F.lit(value))
    return chain.otherwise(F.lit(otherwise).cast("string"))


def _by_value(column: Column, pairs: dict[str, str], otherwise: str | None = None) -> Column:
    chain = F
    for value, label in pairs.items():
        chain = chain.when(column == value, F.lit(label))
    return chain.otherwise(F.lit(otherwise).cast("string"))


SHORT_DESCRIPTIONS = (
    "WiFi connectivity issue", "VPN connection failing", "Printer spits out blank pages",
    "Slow performance on host", "DNS answers late for two sites", "Badge reader offline at the gate",
)
PRIORITIES = {
    "1-URGENT": "1 - Critical", "2-HIGH": "2 - High", "3-MEDIUM": "3 - Moderate",
    "4-NOT SPECIFIED": "4 - Low", "5-LOW": "5 - Planning",
}
STATES = {"O": "New", "P": "In Progress", "F": "Resolved"}
CI_TYPES = {
    "AUTOMOBILE": "Server", "BUILDING": "Access Point", "FURNITURE": "Network Printer",
    "HOUSEHOLD": "WiFi",
}
CLOSE_NOTES = (
    "Misconfigured VLAN corrected.", "Hardware failure on the uplink, part replaced.",
    "Software bug patched.", "Network outage at the provider.", "User error, password reset.",
    "Disk full, log files rotated.", "Unauthorized access blocked.", "",
)
NOTES = (
    "Checked the logs.",
    "Found it. The root cause was a failed route update. Rolled back.",
    "Still down for the whole site",
    "Waiting for the vendor.",
)

INCIDENT_COLUMNS = (
    "number", "sys_id", "parent", "short_description", "description", "priority", "state",
    "opened_at", "resolved_at", "reassignment_count", "location", "ci_type",
    "assignment_group", "caller_id", "assigned_to", "category", "cmdb_ci", "impact",
    "urgency", "close_notes",
)
_NEED_EFFORT = {"resolved_at", "reassignment_count"}
_NEED_CUSTOMER = {
    "description", "location", "ci_type", "assignment_group", "caller_id", "assigned_to",
    "category", "cmdb_ci",
}
_NEED_NATION = {"location", "assignment_group"}
_NEED_REGION = {"location"}


def incidents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order; all columns unless some are named."""
    wanted = columns or INCIDENT_COLUMNS
    needs = set(wanted)
    rows = table(spark, sf_dir, "orders")
    if needs & _NEED_EFFORT:
        effort = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.sum("l_quantity").cast("int").alias("_qty"), F.count("*").cast("int").alias("_lines")
        )
        rows = rows.join(effort, "o_orderkey", "left")
    if needs & _NEED_CUSTOMER:
        customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
        rows = rows.join(customer, "o_custkey", "left")
    if needs & _NEED_NATION:
        nation = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
        rows = rows.join(nation, "c_nationkey", "left")
    if needs & _NEED_REGION:
        region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
        rows = rows.join(region, "n_regionkey", "left")

    key = F.col("o_orderkey")
    customer_name = F.col("c_name")
    priority = _by_value(F.col("o_orderpriority"), PRIORITIES)
    on_even = F.concat(F.lit('{"display_value":"'), customer_name, F.lit('"}'))
    values = {
        "number": lambda: _number("o_orderkey"),
        "sys_id": lambda: _sys_id("o_orderkey"),
        "parent": lambda: F.when((key % 10).isin(3, 6, 9), _sys_id("_parent_key")),
        "short_description": lambda: _choice(key % 7, SHORT_DESCRIPTIONS),
        "description": lambda: F.concat(
            F.lit("Reported by "), customer_name,
            F.lit(" near Room "), (key % 90).cast("string"),
            F.lit(", affecting "), (key % 300).cast("string"), F.lit(" users"),
        ),
        "priority": lambda: priority,
        "state": lambda: _by_value(F.col("o_orderstatus"), STATES),
        "opened_at": lambda: F.col("o_orderdate"),
        "resolved_at": lambda: F.when(
            F.col("o_orderstatus") == "F",
            F.col("o_orderdate") + F.make_dt_interval(hours=F.col("_qty")),
        ),
        "reassignment_count": lambda: F.coalesce("_lines", F.lit(0)),
        "location": lambda: F.concat(
            F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), F.lit(" - "), "n_name",
            F.lit(" - "), "r_name", F.lit(" / "), "c_mktsegment",
        ),
        "ci_type": lambda: _by_value(F.col("c_mktsegment"), CI_TYPES, "Firewall"),
        "assignment_group": lambda: F.concat(
            F.when(key % 3 == 0, F.lit("Network ")).otherwise(F.lit("Desk ")), "n_name"
        ),
        "caller_id": lambda: customer_name,
        "assigned_to": lambda: F.when(key % 2 == 0, on_even).otherwise(customer_name),
        "category": lambda: F.col("c_mktsegment"),
        "cmdb_ci": lambda: F.concat(F.lit("CI-"), F.col("c_nationkey").cast("string")),
        "impact": lambda: priority,
        "urgency": lambda: priority,
        "close_notes": lambda: _choice(key % 9, CLOSE_NOTES),
    }
    if "parent" in needs:
        rows = rows.withColumn("_parent_key", key - key % 10)
    return rows.select(*[values[name]().alias(name) for name in wanted])


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"
    )
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    rows = table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").join(supplier, "l_suppkey", "left")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("entry_id"),
        _sys_id("l_orderkey").alias("element_id"),
        F.lit("incident").alias("name"),
        _choice(F.col("l_linenumber") % 3, ("work_notes", "comments"), "assignment_group").alias("element"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("sys_created_on"),
        F.col("s_name").alias("author"),
        _choice(F.col("l_partkey") % 4, NOTES).alias("value"),
    )


# A problem or change lists the incidents of one block of order numbers, so that no list
# grows with the data, however many orders one part or supplier has.
BLOCK = 10_000


def _listed(lines: DataFrame, key: str) -> DataFrame:
    block = F.floor(F.col("l_orderkey") / BLOCK).alias("_block")
    ids = lines.select(key, block, "l_orderkey").distinct()  # as many as their sys_ids, which are longer
    return ids.groupBy(key, "_block").agg(
        F.array_join(F.array_sort(F.collect_list(_sys_id("l_orderkey"))), ",").alias("incidents")
    )


def _block_number(prefix: str, key: str) -> Column:
    text = F.col(key).cast("string")
    padded = F.lpad(text, F.greatest(F.length(text), F.lit(6)), F.lit("0"))
    return F.concat(F.lit(prefix), padded, F.lit("-"), F.col("_block").cast("string"))


def problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part and block, for parts that are the first line of an order."""
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber = 1")
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    return _listed(lines, "l_partkey").join(part, "l_partkey").select(
        _block_number("PRB", "l_partkey").alias("number"),
        F.col("p_name").alias("short_description"),
        F.lit("2 - High").alias("priority"),
        F.lit("Open").alias("state"),
        F.lit("1995-01-01 00:00:00").alias("opened_at"),
        F.lit(None).cast("string").alias("resolved_at"),
        "incidents",
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier and block, for suppliers of the second line of an order."""
    lines = table(spark, sf_dir, "lineitem").filter("l_linenumber = 2")
    supplier = table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return _listed(lines, "l_suppkey").join(supplier, "l_suppkey").select(
        _block_number("CHG", "l_suppkey").alias("number"),
        F.col("s_name").alias("short_description"),
        F.lit("3 - Moderate").alias("priority"),
        F.lit("Closed").alias("state"),
        F.lit("1995-01-02 00:00:00").alias("opened_at"),
        F.lit("1995-01-03 12:00:00").alias("closed_at"),
        "incidents",
    )


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text per customer with every kind of personal data."""
    key = F.col("c_custkey")
    digits = F.lpad(key.cast("string"), 9, "0")

    def part(start: int, length: int) -> Column:
        return F.substring(digits, start, length)

    text = F.concat(
        F.lit("Anna Berg-"), F.col("c_name"),
        F.lit(" mail a.b+"), key.cast("string"), F.lit("@mail.example.com call +1 (555) "),
        part(5, 3), F.lit("-0"), part(7, 3),
        F.lit(" ssn "), part(1, 3), F.lit("-"), part(4, 2), F.lit("-"), F.lit("1"), part(7, 3),
        F.lit(" host 10.0."), (key % 256).cast("string"), F.lit("."), F.col("c_nationkey").cast("string"),
        F.lit(" at Site-Floor-"), (key % 40).cast("string"),
        F.lit(" Room "), (key % 90).cast("string"), F.lit("."),
    )
    return table(spark, sf_dir, "customer").select("c_custkey", text.alias("text"))


def reference_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with values as exports hold them: objects, texts, blanks, bad numbers."""
    key = F.col("o_orderkey")
    kind = key % 6
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    zoned = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.concat(F.lit("Desk "), key.cast("string"))
    return table(spark, sf_dir, "orders").select(
        _number("o_orderkey").alias("number"),
        F.when(kind == 0, F.concat(F.lit('{"display_value":"'), name, F.lit('"}')))
        .when(kind == 1, F.lit('{"link":"x"}'))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None).cast("string"))
        .otherwise(name)
        .alias("reference"),
        F.when(kind == 0, stamp)
        .when(kind == 1, zoned)
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, F.lit("junk"))
        .otherwise(stamp)
        .alias("stamp"),
        F.when(kind == 0, (key % 9).cast("string"))
        .when(kind == 1, F.lit("3.0"))
        .when(kind == 2, F.lit(""))
        .when(kind == 3, F.lit(None).cast("string"))
        .when(kind == 4, F.lit("many"))
        .otherwise(F.concat(F.lit(" "), (key % 7).cast("string"), F.lit(" ")))
        .alias("amount"),
    )
