"""Runs registered queries and their SQL over the test tables and compares the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(row) for row in df.select(*columns).collect())


def sql_rows(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    columns = sorted(names)
    order = [names.index(c) for c in columns]
    return columns, Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def main() -> int:
    from adstrata.session import build_session

    sf_dir = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sql = duckdb_over(sf_dir), driver.oracle_sql()
    bad = 0
    for name, run in driver.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
        except Exception as error:
            print(name, "SPARK FAILED", str(error)[:1500])
            bad += 1
            continue
        took = time.time() - start
        if name not in sql:
            print(f"{name}: {sum(got[1].values())} rows, no SQL ({took:.1f}s)")
            continue
        try:
            want = sql_rows(connection, sql[name])
        except Exception as error:
            print(name, "SQL FAILED", str(error)[:800])
            bad += 1
            continue
        same = got == want
        bad += not same
        print(f"{name}: {'ok' if same else 'DIFFERS'} {sum(got[1].values())}/{sum(want[1].values())} rows ({took:.1f}s)")
        if not same:
            print("  columns", got[0], want[0])
            print("  only spark", list((got[1] - want[1]).items())[:2])
            print("  only sql  ", list((want[1] - got[1]).items())[:2])
    return bad


if __name__ == "__main__":
    sys.exit(main())
