"""Run registered queries next to their SQL twins and compare all values.

``python -m tests.oracle [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"f{value:.9g}"
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    if isinstance(value, bool):
        return f"b{value}"
    return value if value is None else f"{type(value).__name__[0]}{value}"


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf_dir: str, name: str) -> str | None:
    """None if both sides agree, else what differs."""
    result = queries()[name](spark, sf_dir)
    columns, rows = result.columns, [tuple(r) for r in result.collect()]
    if len(set(columns)) != len(columns):
        return f"repeated columns {columns}"
    if name not in oracle_sql():
        return None if rows else "no rows"
    answer = con.execute(oracle_sql()[name])
    expected_columns, expected = [d[0] for d in answer.description], answer.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} against {sorted(expected_columns)}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    if not rows:
        return "no rows"
    for ours, theirs in zip(_rows(columns, rows), _rows(expected_columns, expected), strict=True):
        if ours != theirs:
            at = [(sorted(columns)[i], a, b) for i, (a, b) in enumerate(zip(ours, theirs)) if a != b]
            return f"{str(at)[:600]} in {str(ours)[:200]}"
    return None


def main() -> None:
    from parley.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(queries())
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = build_session("oracle", "8"), connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, con, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        checked = "sql" if name in oracle_sql() else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {name} [{checked}] {time.time() - start:.1f}s",
              problem or "", flush=True)
        bad += problem is not None
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
