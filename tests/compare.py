"""Compare every registered query with its oracle SQL on DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


# Spark type -> type DuckDB reports for the same column.
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value if value == value and value is not None else None


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def difference(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if both sides return the same rows, else what differs first."""
    df = query(spark, sf_dir)
    ours_columns, ours = _rows(df.columns, [tuple(row) for row in df.collect()])
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs_columns, theirs = _rows(names, result.fetchall())
    if ours_columns != theirs_columns:
        return f"columns {ours_columns} vs {theirs_columns}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    kinds = {column[0]: str(column[1]) for column in result.description}
    mismatched = [(n, k, kinds[n]) for n, k in df.dtypes if KINDS.get(k, k) != kinds[n]]
    if mismatched:
        return f"types {mismatched}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0][0]} vs {wrong[0][1]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from heatgrid.session import build_session

    registered, oracles = queries(), oracle_sql()
    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    wanted = arguments[1:] or list(oracles)
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failures = 0
    for name in wanted:
        start = time.time()
        try:
            problem = difference(spark, connection, registered[name], oracles[name], sf_dir)
        except Exception as error:  # a broken query is a finding, not the end of the run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failures += problem is not None
        print(f"\n{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} match")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
