"""Run every query and its SQL twin on one folder of test tables and compare the rows.

    python -m stallwise.checks.compare /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

from stallwise.checks import duckdb_sql
from stallwise import catalog
from stallwise.session import build_session


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def duckdb_tables(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def differences(spark, connection, folder: str, name: str) -> str | None:
    """What differs between the two results, None if nothing does."""
    frame = catalog.queries()[name](spark, folder)
    expected = connection.execute(duckdb_sql.statements()[name])
    expected_columns = [column[0] for column in expected.description]
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns {sorted(frame.columns)} != {sorted(expected_columns)}"
    kinds = {column[0]: str(column[1]) for column in expected.description}
    got = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    want = rows_of(expected_columns, expected.fetchall())
    if got != want:
        pairs = [(a, b) for a, b in zip(got, want) if a != b][:3]
        return f"{len(got)} rows against {len(want)}; first differences {pairs}"
    whole = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    kind_differs = {c: (k, kinds[c]) for c, k in frame.dtypes if whole.get(k) != kinds[c]}
    return f"types {kind_differs}" if kind_differs else None


def main(folder: str, names: list[str]) -> int:
    spark = build_session("compare", master="local[8]", spark__sql__shuffle__partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duckdb_tables(folder)
    failed = 0
    for name in names or list(catalog.queries()):
        start = time.time()
        problem = differences(spark, connection, folder, name)
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
