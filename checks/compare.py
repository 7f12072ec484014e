"""Run registered queries against their SQL on one data folder and report differences.

    python -m checks.compare /root/testdata/sf0.01 [name-prefix ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from checks import catalog  # noqa: F401  (fills the registry)
from checks.registry import QUERIES
from claimloom.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def canonical(rows) -> list[str]:
    def text(value):
        if isinstance(value, float):
            return f"{value + 0.0:.6f}" if value == value else "nan"
        return str(value)

    return sorted("|".join(text(v) for v in row) for row in rows)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def main(folder: str, prefixes: list[str]) -> int:
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                              "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, query in QUERIES.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        started = time.time()
        try:
            frame = query.run(spark, folder)
            names = sorted(frame.columns)
            ours = canonical([tuple(row[n] for n in names) for row in frame.collect()])
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}")
            bad += 1
            continue
        spent = time.time() - started
        sql = query.oracle()
        if sql is None:
            print(f"rows  {name}: {len(ours)} rows, {spent:.1f}s")
            continue
        started = time.time()
        try:
            result = connection.execute(sql)
            order = [d[0] for d in result.description]
            theirs = canonical([tuple(dict(zip(order, row))[n] for n in names) for row in result.fetchall()])
        except Exception as error:
            print(f"SQLERR {name}: {str(error)[:1500]}")
            bad += 1
            continue
        same = ours == theirs and names == sorted(order)
        print(f"{'ok   ' if same else 'DIFF '} {name}: {len(ours)}/{len(theirs)} rows, "
              f"spark {spent:.1f}s, duckdb {time.time() - started:.1f}s", flush=True)
        if not same:
            bad += 1
            only_ours = sorted(set(ours) - set(theirs))[:4]
            only_theirs = sorted(set(theirs) - set(ours))[:4]
            print("   columns", names, "\n   spark ", only_ours, "\n   duckdb", only_theirs)
    print(f"{bad} problem(s)")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1], sys.argv[2:])))
