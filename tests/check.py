"""Compare every query with its SQL twin; ``python -m tests.check [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def normal(value):
    return tuple(value) if isinstance(value, list) else value


def compare(spark, con, sf_dir: str, name: str, run, sql: str | None) -> tuple[bool, str]:
    df = run(spark, sf_dir)
    order = sorted(df.columns)
    got = sorted((tuple(repr(normal(x)) for x in r) for r in df.select(*[f"`{c}`" for c in order]).collect()))
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != order:
        return False, f"columns {order} against {sorted(names)}"
    places = [names.index(c) for c in order]
    want = sorted(tuple(repr(normal(r[i])) for i in places) for r in cur.fetchall())
    if got != want:
        odd = set(got) ^ set(want)
        return False, f"{len(got)} against {len(want)} rows, {len(odd)} odd ones such as {sorted(odd)[:2]}"
    return True, f"{len(got)} rows"


def main() -> int:
    from tagloom.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = duck(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name, run, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} failures")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
