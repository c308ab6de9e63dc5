"""Run every query beside its SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = []
    for row in frame[columns].itertuples(index=False):
        rows.append(tuple(
            None if v is None or v != v else float(v) if isinstance(v, (int, float)) else str(v)
            for v in (x.item() if hasattr(x, "item") else x for x in row)))
    return sorted(rows, key=repr)


def compare(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    """None when both hold the same columns and values, else what differs."""
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns {sorted(spark_rows.columns)} != {sorted(sql_rows.columns)}"
    left, right = canonical(spark_rows), canonical(sql_rows)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"first difference: spark {a} sql {b}"
    kinds = [(c, spark_rows[c].dtype, sql_rows[c].dtype) for c in sorted(spark_rows.columns)
             if spark_rows[c].dtype != sql_rows[c].dtype]
    return f"types {kinds}" if kinds else None


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, oracles, bad = connect(sf_dir), e.oracle_sql(), 0
    for name, query in e.queries().items():
        if args and name not in args:
            continue
        started = time.monotonic()
        try:
            rows = query(spark, sf_dir).toPandas()
            seconds = time.monotonic() - started
            verdict = (
                compare(rows, db.execute(oracles[name]).fetchdf()) or "ok"
                if name in oracles else "rows only"
            )
        except Exception as error:  # report and go on with the next query
            rows, seconds, verdict = [], time.monotonic() - started, f"ERROR {error}"[:1500]
        bad += verdict not in ("ok", "rows only")
        print(f"{name:28s} {len(rows):7d} rows {seconds:7.2f}s  {verdict}", flush=True)
        if verdict == "rows only" and args:
            print(rows.head(30).to_string())
    spark.stop()
    print("failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
