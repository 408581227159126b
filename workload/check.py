"""Run queries against their DuckDB counterparts: ``python -m workload.check [sf_dir] [name-prefix...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time

TABLES_VIEW = "CREATE VIEW {0} AS SELECT * FROM read_parquet('{1}/{0}.parquet')"


def connect(sf_dir: str):
    import duckdb

    from workload.shapes import TABLES

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(TABLES_VIEW.format(table, sf_dir))
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [normal(v) for v in value]
    return value


def kind(value) -> str:
    return type(value).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b and (a is None or b is None or kind(a) == kind(b))


def compare(df, con, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    left_columns, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    right_columns, right = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} / {right_columns}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if not all(close(x, y) for x, y in zip(a, b)):
            return f"\n    spark {a}\n    duck  {b}"
    return None if left else "EMPTY"


def main(argv: list[str]) -> int:
    from civiclake.session import get_session
    from workload import load

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark_queries, oracle = load()
    spark = get_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                 "spark.ui.showConsoleProgress": "false",
                                                 "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, run in spark_queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, oracle[name]) if name in oracle else (None if df.collect() else "EMPTY")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:45s} {time.time() - began:6.2f}s "
              f"{'' if name in oracle else '(no sql) '}{problem or ''}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
