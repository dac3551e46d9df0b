"""Run every registered query in Spark and its SQL twin in DuckDB and compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the
values (columns sorted by name), like the driver's correctness gate.
"""

from __future__ import annotations

import hashlib
import math
import sys
import time

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, int):
        return str(v)
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def run(sf_dir, names=None, verbose=True):
    from vigilo.session import local_session
    import importlib
    entry = importlib.import_module("__spark_entry__")
    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in sorted(qs):
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
            stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
        except Exception as e:  # noqa: BLE001
            results[name] = ("SPARK-ERROR", str(e)[:300])
            print(f"{name:34s} SPARK-ERROR {str(e)[:300]}")
            continue
        dt = time.time() - t0
        if name not in sqls:
            results[name] = ("rows-only", len(srows))
            print(f"{name:34s} rows-only  rows={len(srows)}  {dt:.1f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols = rel.columns
            dtypes = [str(x) for x in rel.types]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = ("SQL-ERROR", str(e)[:300])
            print(f"{name:34s} SQL-ERROR {str(e)[:300]}")
            continue
        tmap = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                "boolean": "BOOLEAN", "date": "DATE", "smallint": "SMALLINT", "float": "FLOAT"}
        dtype_of = dict(zip(dcols, dtypes))
        tdiff = [(c, t, dtype_of.get(c)) for c, t in zip(scols, stypes) if tmap.get(t, t) != dtype_of.get(c)]
        if tdiff:
            print(f"   TYPE-DIFF {name}: {tdiff}")
        sh, sl = digest(scols, srows)
        dh, dl = digest(dcols, drows)
        ok = not tdiff and (len(srows) == len(drows)) and sorted(scols) == sorted(dcols) and sh == dh
        results[name] = ("OK" if ok else "MISMATCH", len(srows), len(drows))
        print(f"{name:34s} {'OK      ' if ok else 'MISMATCH'} rows={len(srows)}/{len(drows)} {dt:.1f}s")
        if not ok and verbose:
            if sorted(scols) != sorted(dcols):
                print("   cols spark:", scols, "\n   cols duck :", dcols)
            print("   types spark:", list(zip(scols, stypes)))
            print("   types duck :", list(zip(dcols, dtypes)))
            a, b = set(sl), set(dl)
            for x in sorted(a - b)[:4]:
                print("   spark only:", x[:300])
            for x in sorted(b - a)[:4]:
                print("   duck only :", x[:300])
    return results


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    res = run(sf, set(sys.argv[2:]) or None)
    bad = [k for k, v in res.items() if v[0] not in ("OK", "rows-only")]
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
