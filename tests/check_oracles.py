"""Compare registered queries with their SQL twins: ``python tests/check_oracles.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if pd.isna(v):
            return "~null"
        if isinstance(v, float) and v == int(v):
            return str(int(v))
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    got = fn(spark, sf_dir).toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    types = {
        c: (str(got[c].dtype), str(want[c].dtype))
        for c in got.columns
        if not got[c].isna().any() and got[c].dtype.kind in "ifb" and want[c].dtype.kind in "ifb" and got[c].dtype != want[c].dtype
    }
    a, b = _canonical(got), _canonical(want)
    if a == b:
        return f"types differ {types}" if types else None
    extra = [r for r in a if r not in set(b)][:3]
    missing = [r for r in b if r not in set(a)][:3]
    return f"{len(a)} rows != {len(b)} rows; only spark {extra}; only sql {missing}"


def main() -> None:
    from conftest import make_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    plain = SparkSession.builder.master("local[8]").getOrCreate if "--plain" in only else None
    only = [name for name in only if name != "--plain"]
    spark, con, sql = (plain or make_session)(), connect(sf_dir), entry.oracle_sql()
    failed = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        begin = time.time()
        try:
            if name in sql:
                problem = compare(spark, con, name, fn, sql[name], sf_dir)
            else:
                problem = f"no sql, {fn(spark, sf_dir).count()} rows"
        except Exception as e:
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{time.time() - begin:6.2f}s {name}: {problem or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main()
