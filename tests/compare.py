"""Run registered queries on Spark and their SQL on a second engine, and compare the rows.

``python tests/compare.py <table folder> [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def second_engine(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    ordered = frame[sorted(frame.columns)]
    columns = []
    for name in ordered.columns:
        values = ordered[name]
        if pd.api.types.is_numeric_dtype(values.dtype):
            columns.append([None if pd.isna(v) else float(v) for v in values])
        else:
            columns.append([None if pd.isna(v) else str(v) for v in values])
    return list(zip(*columns, strict=True))


def compare(spark, con, name: str, query, sql: str, root: str) -> tuple[bool, str]:
    t0 = time.time()
    got = query(spark, root).toPandas()
    t1 = time.time()
    want = con.execute(sql).fetchdf()
    t2 = time.time()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = Counter(rows_of(got)), Counter(rows_of(want))
    timing = f"{len(got)} rows, spark {t1 - t0:.1f}s, sql {t2 - t1:.1f}s"
    if a == b:
        return True, timing
    extra, missing = a - b, b - a
    detail = [f"{timing}; {len(want)} expected; {sum(extra.values())} extra, {sum(missing.values())} missing"]
    detail.append(f"  columns {sorted(got.columns)}")
    for label, diff in (("extra", extra), ("missing", missing)):
        detail += [f"  {label} {row}" for row in sorted(diff, key=str)[:4]]
    return False, "\n".join(detail)


def main(root: str, names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = second_engine(root)
    queries, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in names or list(queries):
        try:
            if name not in sqls:
                print(f"rows {name}: {queries[name](spark, root).count()}", flush=True)
                continue
            ok, detail = compare(spark, con, name, queries[name], sqls[name], root)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, detail = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {detail}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
