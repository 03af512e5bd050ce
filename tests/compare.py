"""Run registered queries against their SQL and compare the complete results."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Same column order, one spelling per value, sorted rows."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            frame[name] = column.astype("datetime64[us]").astype(str)
        elif column.dtype == object and column.map(lambda v: hasattr(v, "isoformat")).any():
            frame[name] = pd.to_datetime(column).astype("datetime64[us]").astype(str)
        elif pd.api.types.is_float_dtype(column):
            frame[name] = column.map(lambda v: "" if pd.isna(v) else repr(float(v)))
        else:
            frame[name] = column.map(lambda v: "" if pd.isna(v) else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str:
    left, right = normal(spark_rows), normal(sql_rows)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    unequal = left.ne(right).any(axis=1)
    if unequal.any():
        return (f"{unequal.sum()} rows differ\n{left[unequal].head(3).to_string()}\n"
                f"{right[unequal].head(3).to_string()}")
    return ""


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from tradewake.session import build_session

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-")})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, bad = connect(folder), oracle_sql(), []
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            result = query(spark, folder).toPandas()
            spent = time.perf_counter() - start
            found = differences(result, con.execute(oracle[name]).df())
        except Exception as error:  # report and go on with the next query
            found, spent, result = f"{type(error).__name__}: {str(error)[:400]}", 0.0, []
        if found:
            bad.append(name)
        print(f"{name:28s} {len(result):8d} rows {spent:6.2f}s  {found or 'ok'}", flush=True)
    print("FAILED:" if bad else "all equal", *bad)
