"""Run registered queries against their DuckDB oracles (a local stand-in for the
driver's correctness gate): row count, column names and order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, ".")
import __spark_entry__ as E  # noqa: E402
from tidemill.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            cols = df.columns
            got = rows_of(cols, [tuple(r) for r in df.collect()])
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sql:
            print(f"ROWS {name}: {len(got)} rows (no oracle) {dt:.1f}s")
            continue
        try:
            res = con.execute(sql[name])
            ocols = [d[0] for d in res.description]
            exp = rows_of(ocols, res.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            bad += 1
        elif got != exp:
            diff = [r for r in got if r not in set(exp)][:3]
            miss = [r for r in exp if r not in set(got)][:3]
            print(f"FAIL {name}: {len(got)} vs {len(exp)} rows; extra {diff}; missing {miss}")
            bad += 1
        else:
            print(f"ok   {name}: {len(got)} rows {dt:.1f}s")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
