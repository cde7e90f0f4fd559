"""Compare every registered query with its SQL counterpart on one scale factor.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def normalized(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)), key=repr)


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if hasattr(value, "item"):
        return value.item()
    return value


def mismatch(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if equal, else a short description."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    left, right = normalized(spark_frame), normalized(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if repr(a) != repr(b) and not _same_numbers(a, b):
            return f"{a} != {b}"
    return None


def _same_numbers(a: tuple, b: tuple) -> bool:
    """Equal but for integers that a nullable column turned into floats."""
    return all(x == y for x, y in zip(a, b))


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from fleetlake.session import local_session

    folder, *names = sys.argv[1:]
    spark = local_session("oracle_check", os.environ.get("BENCH_CPUS", "8"))
    con = oracle_connection(folder)
    oracle = oracle_sql()
    failed = 0
    for name, query in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            found = query(spark, folder).toPandas()
            took = time.time() - start
            problem = mismatch(found, con.execute(oracle[name]).df()) if name in oracle else None
        except Exception as error:  # report and go on
            found, took, problem = pd.DataFrame(), time.time() - start, f"{type(error).__name__}: {error}"[:600]
        failed += bool(problem)
        state = "FAIL" if problem else "ok  " if name in oracle else "rows"
        print(f"{state} {name:28s} {len(found):7d} rows {took:6.2f} s  {problem or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
