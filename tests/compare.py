"""Local stand-in for the driver's differential check: Spark query vs DuckDB SQL."""
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from dirlens.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows), [cols[i] for i in order]


def main():
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    only = sys.argv[1:]
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sq = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sq:
            print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sq[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL-ERROR {str(e)[:300]}")
            bad += 1
            continue
        a, ac = rows_of(scols, srows)
        b, bc = rows_of(dcols, drows)
        ok = ac == bc and a == b
        bad += not ok
        msg = "OK" if ok else "MISMATCH"
        print(f"{name:28s} {msg} spark={len(a)} duck={len(b)} {ts:.1f}s")
        if not ok:
            if ac != bc:
                print("   cols", ac, bc)
            sa, sb = set(a), set(b)
            print("   spark-only", list(sa - sb)[:3])
            print("   duck-only ", list(sb - sa)[:3])
    print("BAD", bad)


if __name__ == "__main__":
    main()
