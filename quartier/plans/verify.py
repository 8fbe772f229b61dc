"""Compare every registered query with its DuckDB oracle.

    python -m quartier.plans.verify [--sf DIR] [name ...]

Mirrors the driver's gate: same column names, same row count, and the same
multiset of rows (doubles compared to 1e-9 relative tolerance).
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    import os
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.isdir(path):
            path = f"{path}/*.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    try:
        import pandas as pd
        if v is pd.NaT:
            return ("~null",)
        if isinstance(v, pd.Timestamp):
            v = v.to_pydatetime()
    except ImportError:
        pass
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", v)
    if isinstance(v, bool):
        return ("b", int(v))
    if isinstance(v, int):
        return ("f", float(v))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    if hasattr(v, "__float__") and not isinstance(v, str):
        return ("f", float(v))
    return ("s", str(v))


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x[0], str(x[1]) if len(x) > 1 and x[0] != "f"
                                       else round(x[1], 6) if len(x) > 1 else 0) for x in t))


EXACT = False   # --exact: doubles must be bit-identical


def _close(a, b) -> bool:
    if a[0] != b[0]:
        return False
    if a[0] == "f" and not EXACT:
        return math.isclose(a[1], b[1], rel_tol=1e-9, abs_tol=1e-9)
    return a == b


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                  "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT"}


def _type_diff(sdf, rel) -> dict:
    duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    return {c: (t, duck.get(c)) for c, t in sdf.dtypes
            if _SPARK_TO_DUCK.get(t, t) != duck.get(c)}


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from .catalog import ORACLE, QUERIES
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    scols = sorted(sdf.columns)
    t1 = time.time()
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    con = con or duck(sf_dir)
    rel = con.sql(ORACLE[name])
    dcols = sorted(rel.columns)
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    res["duck_rows"] = len(drows)
    if scols != dcols:
        res["status"] = f"columns differ: spark={scols} duck={dcols}"
        return res
    tdiff = _type_diff(sdf, rel)
    if tdiff:
        res["status"] = f"types differ: {tdiff}"
        return res
    if len(srows) != len(drows):
        res["status"] = "row count differs"
        return res
    a, b = _rows(srows, scols), _rows(drows, dcols)
    bad = 0
    first = None
    for x, y in zip(a, b):
        if not all(_close(p, q) for p, q in zip(x, y)):
            bad += 1
            first = first or (x, y)
    res["status"] = "match" if bad == 0 else f"{bad} rows differ, first: {first}"
    return res


def compare_via_parquet(spark, name: str, sf_dir: str, con) -> dict:
    """Scalable check: Spark writes the result to the shared folder, DuckDB
    diffs it against the oracle (EXCEPT ALL both ways, doubles rounded to 6
    decimals).  Nothing is collected to the driver."""
    from ..session import scratch_path
    from .catalog import ORACLE, QUERIES
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    out = scratch_path(spark, f"verify-{name}")
    df.write.mode("overwrite").parquet(out)
    res = {"name": name, "spark_sec": round(time.time() - t0, 2)}
    types = dict(df.dtypes)
    cols = sorted(df.columns)

    def norm(c: str) -> str:
        return f'round("{c}", 6) as "{c}"' if types[c] in ("double", "float") else f'"{c}"'
    sel = ", ".join(norm(c) for c in cols)
    s_rel = f"select {sel} from read_parquet('{out}/*.parquet')"
    res["spark_rows"] = con.sql(f"select count(*) from ({s_rel})").fetchall()[0][0]
    if name not in ORACLE:
        res["status"] = "rows-only"
        return res
    o_rel = f"select {sel} from ({ORACLE[name]})"
    n_o, only_s, only_o = con.sql(
        f"select (select count(*) from ({o_rel})), "
        f"(select count(*) from ({s_rel} except all {o_rel})), "
        f"(select count(*) from ({o_rel} except all {s_rel}))").fetchall()[0]
    res["duck_rows"] = n_o
    res["status"] = "match" if only_s == only_o == 0 and n_o == res["spark_rows"] else \
        f"differ: {only_s} spark-only, {only_o} oracle-only rows"
    return res


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--parquet", action="store_true",
                    help="diff through written parquet (for large scale factors)")
    ap.add_argument("--exact", action="store_true",
                    help="doubles must match bit for bit (no tolerance)")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    global EXACT
    EXACT = a.exact
    from ..session import get_session
    from .catalog import QUERIES, load_all
    load_all()
    spark = get_session("local[8]", shuffle_partitions=16 if a.parquet else 8,
                        extra={"spark.driver.memory": "16g"})
    con = duck(a.sf)
    names = a.names or list(QUERIES)
    failed = 0
    for n in names:
        try:
            r = (compare_via_parquet if a.parquet else compare)(spark, n, a.sf, con)
        except Exception as e:  # report and continue with the next query
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("match", "rows-only")
        failed += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
