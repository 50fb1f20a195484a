"""Compare a Spark query with its DuckDB oracle text.

Mirrors the driver's check: same row count, same (sorted) column names and an
order-insensitive comparison of the values.
"""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    tz = os.environ.get("ORACLE_DUCKDB_TZ", "UTC")
    if tz != "default":
        con.execute(f"SET TimeZone='{tz}'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, _dt.date) and not isinstance(v, _dt.datetime):
        return _dt.datetime.combine(v, _dt.time())
    if isinstance(v, pd.Timestamp):
        return v.tz_convert(None).to_pydatetime() if v.tzinfo else v.to_pydatetime()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    sdf = fn(spark, sf_dir).toPandas()
    odf = duck(sf_dir).execute(sql).df()
    if sorted(sdf.columns) != sorted(odf.columns):
        return False, f"columns differ: spark={sorted(sdf.columns)} oracle={sorted(odf.columns)}"
    if len(sdf) != len(odf):
        return False, f"row count differ: spark={len(sdf)} oracle={len(odf)}"
    a, b = _rows(sdf), _rows(odf)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, first: spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(sdf)} rows equal"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import time

    import __spark_entry__ as E
    from pricerisk.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8"})
    qs, orc = E.queries(), E.oracle_sql()
    fails = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        if name not in orc:
            n = fn(spark, sf).count()
            print(f"{name:32s} NO-ORACLE rows={n} {time.time() - t:.1f}s")
            continue
        try:
            ok, msg = compare(spark, fn, orc[name], sf)
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error {type(e).__name__}: {str(e)[:300]}"
        fails += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {msg} {time.time() - t:.1f}s")
    print("FAILS", fails)
