"""Run queries and their SQL side by side: ``python -m checks.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from outagelens.session import local_session

from .catalog import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB in this process with one view per table."""
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.12g}"
    return value


def sorted_rows(columns, rows) -> tuple[list, list]:
    """Columns by name, and rows in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: tuple(map(repr, row)))


def difference(spark, con, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL, or None."""
    df = QUERIES[name](spark, sf_dir)
    columns, rows = sorted_rows(df.columns, [tuple(row) for row in df.collect()])
    if name not in ORACLES:
        return None
    result = con.execute(ORACLES[name])
    other_columns, other_rows = sorted_rows([c[0] for c in result.description], result.fetchall())
    if columns != other_columns:
        return f"columns {columns} / {other_columns}"
    if len(rows) != len(other_rows):
        return f"rows {len(rows)} / {len(other_rows)}"
    unequal = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    return f"{len(unequal)} unequal rows, first {unequal[0]}" if unequal else None


def main(arguments: list[str]) -> int:
    sf_dir = f"/root/testdata/sf{arguments[0] if arguments else '0.01'}"
    names = arguments[1:] or list(QUERIES)
    spark, con = local_session(), database(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        label = "ok " if name in ORACLES else "ran"
        print(f"{label if problem is None else 'BAD'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
