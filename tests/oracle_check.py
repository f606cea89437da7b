"""Compare every registered query with its DuckDB statement.

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from contactloom.plans.views import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return int(v) if v == int(v) else round(v, 6)
    if hasattr(v, "is_integer") or type(v).__name__ == "Decimal":
        return norm(float(v))
    return str(v) if not isinstance(v, (int, bool)) else v


def rowset(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return sorted(cols), out


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, sf_dir, name, fn, sql):
    df = fn(spark, sf_dir)
    cols, rows = rowset(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(rows), ""
    cur = con.execute(sql)
    dcols, drows = rowset([d[0] for d in cur.description], cur.fetchall())
    if cols != dcols:
        return False, len(rows), f"columns {cols} vs {dcols}"
    if rows != drows:
        a, b = set(rows) - set(drows), set(drows) - set(rows)
        return False, len(rows), (
            f"rows {len(rows)} vs {len(drows)}\n   spark only: {sorted(a)[:2]}\n   duck only:  {sorted(b)[:2]}"
        )
    return True, len(rows), ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC")).config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    sqls = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            ok, n, why = compare(spark, con, sf, name, fn, sqls.get(name))
        except Exception as e:  # report and go on
            ok, n, why = False, -1, "".join(traceback.format_exception_only(e))[:700]
        bad += ok is False
        print(f"{'ok ' if ok else '-- ' if ok is None else 'BAD'} {name:28s} {n:7d} {time.time() - t:6.1f}s {why}", flush=True)
    print("failed:", bad)
