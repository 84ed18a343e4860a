"""Run registered queries against their SQL text on DuckDB and compare all values.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value) if value != value.to_integral_value() else int(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(frame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree, else a short account of the difference."""
    ours = normal(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    theirs = normal([d[0] for d in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} vs {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} vs {len(theirs[1])}"
    kinds = [{type(r[i]).__name__ for r in ours[1]} ^ {type(r[i]).__name__ for r in theirs[1]} for i in range(len(ours[0]))]
    bad = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours[1])} rows differ, first: {ours[0]}\n   ours   {bad[0][0]}\n   theirs {bad[0][1]}"
    mixed = {name: kind for name, kind in zip(ours[0], kinds) if kind}
    return f"types differ: {mixed}" if mixed else ""


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from roomtide.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = get_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), []
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        start = time.time()
        try:
            if name in sqls:
                difference = compare(run(spark, sf_dir), con, sqls[name])
            else:
                difference = "" if run(spark, sf_dir).collect() else "no rows"
        except Exception as error:
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        status = "ok  " if not difference else "FAIL"
        print(f"{status} {name:32s} {time.time() - start:6.1f}s {'' if name in sqls else '(rows only) '}{difference}", flush=True)
        if difference:
            failed.append(name)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
