"""Side-by-side run of a job and its SQL twin: ``python tests/check.py [names...]``."""

from __future__ import annotations

import datetime
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if v is None or v != v:
        return "~"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, float):
        return f"f{v!r}"
    if isinstance(v, decimal.Decimal):
        return f"d{v.normalize()}"
    if isinstance(v, datetime.datetime):
        return f"t{v.isoformat()}"
    return f"s{v}"


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, con, job, sql, sf_dir):
    df = job(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, got
    rel = con.execute(sql)
    want = rows_of([d[0] for d in rel.description], rel.fetchall())
    return want, got


def main():
    import __spark_entry__ as entry
    from fathomkit.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    queries, oracles = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:]
    names = [n for n in queries if not wanted or any(n.startswith(w) for w in wanted)]
    spark, con, bad = build_session("8"), duck(sf_dir), []
    for n in names:
        t = time.time()
        try:
            want, got = compare(spark, con, queries[n], oracles.get(n), sf_dir)
        except Exception as e:  # noqa: BLE001
            bad.append(n)
            print(f"ERR  {n}: {str(e)[:700]}", flush=True)
            continue
        took = f"{time.time() - t:.1f}s"
        if want is None:
            print(f"rows {n} {len(got[1])} {took}", flush=True)
        elif want == got:
            print(f"ok   {n} {len(got[1])} {took}", flush=True)
        else:
            bad.append(n)
            print(f"DIFF {n} want {len(want[1])} got {len(got[1])} {took}\n  {want[0]}\n  {got[0]}")
            a, b = set(want[1]), set(got[1])
            print("  want", sorted(a - b)[:3], "\n  got ", sorted(b - a)[:3], flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} fine; bad: {bad}")


if __name__ == "__main__":
    main()
