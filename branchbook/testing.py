"""Spark-vs-DuckDB comparison used by the tests and by ``python -m branchbook.testing``.

Rows are compared order-free: both sides are normalised (columns by name, values
to plain Python), sorted, and compared exactly and with a float tolerance.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, tol: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}") if tol else v
    if isinstance(v, decimal.Decimal):
        f = float(v)
        return float(f"{f:.9g}") if tol else f
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, tol) for x in v)
    if hasattr(v, "item"):
        return _norm(v.item(), tol)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def rows_of(cols: list[str], rows: list[tuple], tol: bool) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], tol) for i in order) for r in rows]
    return sorted(out, key=_key)


def compare(spark, key: str, sf_dir: str, con=None, verbose: bool = True) -> dict:
    from branchbook.plans import catalog

    catalog.load_all()
    res: dict = {"key": key}
    t0 = time.time()
    sdf = catalog.QUERIES[key](spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res["spark_sec"] = round(time.time() - t0, 2)
    res["spark_rows"] = len(srows)
    sql = catalog.ORACLE.get(key)
    if sql is None:
        res["status"] = "no_oracle"
        return res
    con = con or duckdb_con(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = [tuple(r) for r in cur.fetchall()]
    res["oracle_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = "schema"
        res["detail"] = f"spark={sorted(scols)} oracle={sorted(dcols)}"
        return res
    exact = rows_of(scols, srows, False) == rows_of(dcols, drows, False)
    loose_s, loose_d = rows_of(scols, srows, True), rows_of(dcols, drows, True)
    if exact:
        res["status"] = "exact"
    elif loose_s == loose_d:
        res["status"] = "tolerant"
    else:
        res["status"] = "MISMATCH"
        diff_s = [r for r in loose_s if r not in set(loose_d)][:3]
        diff_d = [r for r in loose_d if r not in set(loose_s)][:3]
        res["detail"] = f"cols={sorted(scols)}\n spark-only={diff_s}\n oracle-only={diff_d}"
    return res


def main(argv: list[str]) -> int:
    from branchbook.plans import catalog
    from branchbook.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    keys = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    catalog.load_all()
    keys = keys or list(catalog.QUERIES)
    con = duckdb_con(sf_dir)
    bad = 0
    for k in keys:
        try:
            r = compare(spark, k, sf_dir, con)
        except Exception as exc:  # noqa: BLE001
            r = {"key": k, "status": "ERROR", "detail": str(exc)[:600]}
        if r["status"] in ("MISMATCH", "ERROR", "schema"):
            bad += 1
        print(r["key"], r["status"], r.get("spark_rows"), r.get("oracle_rows"), r.get("spark_sec"), flush=True)
        if "detail" in r:
            print("   ", r["detail"], flush=True)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
