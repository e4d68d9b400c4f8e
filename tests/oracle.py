"""Compare a query with its SQL oracle run by DuckDB, as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value + 0.0 if isinstance(value, float) else value


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(record[i]) for i in order) for record in records)


def differences(spark, query, sf_dir: str) -> list[str]:
    """What differs between a query and its oracle, empty if nothing does."""
    result = query.run(spark, sf_dir)
    expected = connect(sf_dir).execute(query.sql)
    names = [column[0] for column in expected.description]
    if sorted(result.columns) != sorted(names):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    got = rows(result.columns, map(tuple, result.collect()))
    want = rows(names, expected.fetchall())
    if got == want:
        return [] if want else ["no rows at all"]
    extra, missing = got - want, want - got
    return [
        f"{sum(got.values())} rows instead of {sum(want.values())}",
        f"extra: {list(extra)[:2]}",
        f"missing: {list(missing)[:2]}",
    ]
