"""Run registered queries next to their SQL in DuckDB and compare.

    python tests/oracle.py [name ...]      # ORACLE_SF_DIR chooses the data
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_extension_array_dtype(df[c].dtype) and df[c].isna().any() and df[c].dtype.kind in "iub":
            df[c] = df[c].astype("float64")  # as Spark hands over whole numbers with nulls
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]")
        elif pd.api.types.is_object_dtype(df[c]) or pd.api.types.is_string_dtype(df[c]):
            df[c] = df[c].astype(object).where(df[c].notna(), None)
    text = df.map(lambda v: "" if v is None or v is pd.NaT or v != v else repr(v))
    return df.loc[text.sort_values(list(df.columns)).index].reset_index(drop=True)


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """What differs, None if nothing does."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} vs {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    a, b = normal(ours), normal(theirs)
    kinds = [(c, a[c].dtype, b[c].dtype) for c in a.columns
             if a[c].dtype.kind != b[c].dtype.kind and len(a)]
    if kinds:
        return f"types {kinds}"
    for c in a.columns:
        same = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        if not same.all():
            i = same.idxmin()
            return f"{c}: {int((~same).sum())} differ, first {a.loc[i].to_dict()} vs {b.loc[i].to_dict()}"
    return None


def compare(spark, con, name: str, folder: str = SF_DIR) -> tuple[str | None, int]:
    import __spark_entry__ as entry

    ours = entry.queries()[name](spark, folder).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(ours)
    return difference(ours, con.execute(sql).df()), len(ours)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tidelog import build_session

    spark = build_session("local[8]", shuffle_partitions=8, memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = database(SF_DIR)
    bad = []
    for name in sys.argv[1:] or list(entry.queries()):
        began = time.time()
        try:
            diff, rows = compare(spark, con, name)
        except Exception as e:  # report every query, not only the first that fails
            diff, rows = f"{type(e).__name__}: {str(e)[:600]}", -1
        print(f"{'OK ' if diff is None else 'BAD'} {name:28s} {rows:8d} rows {time.time() - began:6.2f}s"
              + ("" if name in entry.oracle_sql() else "  (rows only)")
              + ("" if diff is None else f"\n      {diff}"), flush=True)
        bad += [name] if diff else []
    print(f"{len(bad)} differ: {bad}")
