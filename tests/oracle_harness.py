"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
Compares row counts, column names and an order-insensitive hash of values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def canon(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return canon(v.item())
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str, list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h, lines


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as E

    qs, sql = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or list(qs):
        rec: dict = {"name": name}
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            s = digest(sdf.columns, srows)
            rec["spark_rows"], rec["spark_sec"] = s[0], round(time.time() - t0, 2)
        except Exception as exc:  # noqa: BLE001
            rec["error"] = f"spark: {type(exc).__name__}: {str(exc)[:400]}"
            results[name] = rec
            if verbose:
                print(name, rec)
            continue
        if name not in sql:
            rec["oracle"] = "none"
            results[name] = rec
            if verbose:
                print(name, rec)
            continue
        try:
            cur = con.execute(sql[name])
            cols = [d[0] for d in cur.description]
            drows = cur.fetchall()
            d = digest(cols, drows)
        except Exception as exc:  # noqa: BLE001
            rec["error"] = f"duckdb: {type(exc).__name__}: {str(exc)[:400]}"
            results[name] = rec
            if verbose:
                print(name, rec)
            continue
        rec["oracle_rows"] = d[0]
        rec["columns_match"] = s[1] == d[1]
        rec["hash_match"] = s[2] == d[2]
        if not rec["columns_match"]:
            rec["spark_cols"], rec["oracle_cols"] = s[1], d[1]
        elif not rec["hash_match"]:
            only_s = sorted(set(s[3]) - set(d[3]))[:3]
            only_d = sorted(set(d[3]) - set(s[3]))[:3]
            rec["cols"] = s[1]
            rec["only_spark"], rec["only_oracle"] = only_s, only_d
        results[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return results


def main() -> None:
    from shelfguard.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = build_session(master="local[8]", shuffle_partitions=8)
    res = compare(spark, sf_dir, names)
    ok = [n for n, r in res.items() if r.get("hash_match") and r.get("columns_match")]
    print(f"\nPASS {len(ok)}/{len(res)}")
    for n, r in res.items():
        if n not in ok:
            print("FAIL", n)


if __name__ == "__main__":
    main()
