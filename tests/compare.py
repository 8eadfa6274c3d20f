"""Run registered queries against their SQL counterparts: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        frame[c] = [None if pd.isna(v) else str(v) for v in frame[c].astype(object)]
    return frame.sort_values(list(frame.columns), na_position="first").reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if equal, else a description."""
    a, b = sorted(spark_frame.columns), sorted(sql_frame.columns)
    if a != b:
        return f"columns differ: {sorted(set(a) ^ set(b))}"
    if len(spark_frame) != len(sql_frame):
        return f"rows differ: {len(spark_frame)} and {len(sql_frame)}"
    kinds = {c: (str(spark_frame[c].dtype), str(sql_frame[c].dtype)) for c in a}
    odd = {c: k for c, k in kinds.items() if k[0] != k[1] and not all("date" in x or "object" in x for x in k)}
    odd.update({c: "integer with nulls" for c in a if "Int" in kinds[c][1] and sql_frame[c].isna().any()})
    x, y = canonical(spark_frame), canonical(sql_frame)
    bad = {c: int((x[c].fillna("~") != y[c].fillna("~")).sum()) for c in a}
    bad = {c: n for c, n in bad.items() if n}
    if bad:
        c = next(iter(bad))
        at = (x[c].fillna("~") != y[c].fillna("~")).idxmax()
        return f"values differ: {bad}\n{x.loc[at].to_dict()}\n{y.loc[at].to_dict()} {odd}"
    return f"types differ: {odd}" if odd else None


def main(sf_dir: str, names: list[str]) -> int:
    from dailypanel.queries.all import ORACLES, QUERIES
    from dailypanel.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names or QUERIES:
        try:
            t = time.time()
            got = QUERIES[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in ORACLES:
                print(f"rows  {name} rows={len(got)} {t1 - t:.1f}s")
                continue
            want = con.execute(ORACLES[name]).df()
            problem = difference(got, want)
            t2 = time.time()
        except Exception as error:  # report and go on with the next query
            problem, t1, t2, got = f"{type(error).__name__}: {str(error)[:1500]}", t, t, []
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '}  {name} rows={len(got)} spark={t1 - t:.1f}s sql={t2 - t1:.1f}s")
        if problem:
            print("      " + problem)
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]) and 1)
