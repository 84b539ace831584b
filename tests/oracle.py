"""Compare registered queries with their oracle SQL on DuckDB."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return connection


def differences(connection, sql: str, result) -> str | None:
    """None if ``result`` holds the rows of ``sql`` under the same column names and plain types, in any order."""
    answer = connection.execute(sql)
    expected_columns = [d[0] for d in answer.description]
    expected_rows = answer.fetchall()
    columns = sorted(result.columns)
    if sorted(expected_columns) != columns:
        return f"columns {columns} for {sorted(expected_columns)}"
    order = [expected_columns.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in expected_rows)
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows for {sum(expected.values())}; "
        f"missing {sum(missing.values())} e.g. {str(list(missing)[:2])[:600]}; "
        f"extra {sum(extra.values())} e.g. {str(list(extra)[:2])[:600]}"
    )


def main() -> None:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    from arborsync.catalog import full_catalog
    from arborsync.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    catalog = full_catalog()
    spark = build_session("oracle")
    connection = connect(folder)
    failures = 0
    for name, query in catalog.queries.items():
        if names and name not in names:
            continue
        start, size = time.time(), 0
        try:
            sql = catalog.oracles.get(name)
            result = query(spark, folder)
            verdict = differences(connection, sql, result) if sql else f"no oracle, {result.count()} rows"
            if verdict is None:
                size = connection.execute(f"select count(*) from ({sql})").fetchall()[0][0]
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:700]}"
        failures += verdict is not None and not verdict.startswith("no oracle")
        print(f"{name}: {verdict or f'ok, {size} rows'} ({time.time() - start:.1f}s)", flush=True)
    print(f"{failures} failures", flush=True)


if __name__ == "__main__":
    main()
