"""Runs registered queries next to their SQL: python -m tests.compare [sf_dir] [name ...]"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd

import __spark_entry__ as contract
from lodestone.session import spark_session


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal, types included."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    whole = [c for c in got.columns if got[c].dtype == "float64" and str(want[c].dtype) == "Int64"]
    got = got.astype({c: "Int64" for c in whole})  # whole numbers with nulls
    got, want = normal(got), normal(want)
    types = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got.columns if got[c].dtype != want[c].dtype]
    if types:
        return f"types {types}"
    if got.equals(want):
        return None
    where = ~((got == want) | (got.isna() & want.isna())).all(axis=1)
    return f"{where.sum()} of {len(got)} rows differ:\n{got[where].head(3)}\n{want[where].head(3)}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> None:
    spark = spark_session(
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle = duck(sf_dir), contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.time() - start
            bad = difference(got, con.execute(oracle[name]).df()) if name in oracle else "no SQL"
        except Exception as e:  # report and go on
            took, got, bad = time.time() - start, (), f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{name:26} {len(got):8} rows {took:6.1f} s  {'equal' if bad is None else bad}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
