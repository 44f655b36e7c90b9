"""Run registered queries and their SQL side by side.

    python tests/checker.py <scale folder> [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        number = float(value)
        return None if math.isnan(number) else f"{number + 0.0:.6f}".replace("-0.000000", "0.000000")
    return str(value)


def rows_of(columns: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=lambda r: tuple((c is not None, c or "") for c in r))


def compare(spark, connection, name: str, function, sql: str | None, folder: str) -> tuple[bool, str]:
    start = time.time()
    df = function(spark, folder)
    got = df.collect()
    seconds = time.time() - start
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if node in plan:
            return False, f"{name}: plan holds {node}"
    if sql is None:
        return True, f"{name}: {len(got)} rows, no SQL, {seconds:.1f}s"
    start = time.time()
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    both = f"{seconds:.1f}s spark, {time.time() - start:.1f}s sql"
    got_names, got_rows = rows_of(df.columns, got)
    want_names, want_rows = rows_of(names, want)
    if got_names != want_names:
        return False, f"{name}: columns {got_names} against {want_names}"
    if got_rows != want_rows:
        extra = [r for r in got_rows if r not in set(want_rows)][:3]
        missing = [r for r in want_rows if r not in set(got_rows)][:3]
        short = lambda rows: [tuple((c[:150] if c else c) for c in r) for r in rows]
        return False, f"{name}: {len(got_rows)} against {len(want_rows)} rows\n  only spark {short(extra)}\n  only sql {short(missing)}"
    return True, f"{name}: {len(got_rows)} rows equal, {both}"


def main() -> None:
    import __spark_entry__ as entry
    from opinara.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, function in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        try:
            good, text = compare(spark, connection, name, function, oracle.get(name), folder)
        except Exception as problem:  # keep going, report all
            good, text = False, f"{name}: {type(problem).__name__} {str(problem)[:1500]}"
        failed += not good
        print("ok  " if good else "FAIL", text, flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
