"""Runs registered queries on both engines and compares whole results.

    python -m tests.compare <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

import __spark_entry__ as entry_point
from coldloop.session import local_session


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal: same columns, rows and bits; otherwise what differs first."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got, want = canonical(got), canonical(want)
    for name in got.columns:
        left, right = got[name].astype(object), want[name].astype(object)
        unequal = ~((left == right) | (left.isna() & right.isna()))
        if unequal.any():
            at = unequal.idxmax()
            return (f"{name}: {unequal.sum()} unequal, first {got.loc[at].to_dict()} "
                    f"!= {want.loc[at].to_dict()}")
    return None


def main(sf_dir: str, names: list[str]) -> int:
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = duckdb_tables(sf_dir), entry_point.oracle_sql(), 0
    for name, query in entry_point.queries().items():
        if names and name not in names:
            continue
        begin = time.perf_counter()
        got = query(spark, sf_dir).toPandas()
        seconds = time.perf_counter() - begin
        if name in oracle:
            problem = difference(got, con.execute(oracle[name]).df())
        else:
            problem = None if len(got) else "no rows"
        failed += problem is not None
        print(f"{name:20s} {len(got):8d} rows {seconds:6.2f} s  {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
