"""Run registered queries beside their SQL in DuckDB and compare the rows.

    python tools/check.py [--sf DIR] [name …]
"""

from __future__ import annotations

import argparse
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from datamill.plans import catalog  # noqa: E402
from datamill.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def ordered_rows(frame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(
            None if value is None or value != value else value
            for value in row
        )
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def differences(spark_frame, sql_frame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows and {len(sql_frame)} rows"
    left, right = ordered_rows(spark_frame), ordered_rows(sql_frame)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, first: {wrong[0]}"
    kinds = {
        name: (spark_frame[name].dtype.kind, sql_frame[name].dtype.kind)
        for name in spark_frame.columns
        if spark_frame[name].dtype != sql_frame[name].dtype
    }
    return f"OK but types {kinds}" if kinds else None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(args.sf)
    failed = 0
    for name in args.names or list(catalog.QUERIES):
        begin = time.time()
        frame = catalog.QUERIES[name](spark, args.sf).toPandas()
        took = time.time() - begin
        if name not in catalog.ORACLES:
            print(f"{name:32s} {took:7.2f}s {len(frame):8d} rows, no SQL", flush=True)
            continue
        begin = time.time()
        twin = connection.execute(catalog.ORACLES[name]).df()
        sql_took = time.time() - begin
        problem = differences(frame, twin)
        failed += problem is not None and not problem.startswith("OK")
        print(f"{name:32s} {took:7.2f}s {sql_took:6.2f}s {len(frame):8d} rows  {problem or 'OK'}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
