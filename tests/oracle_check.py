"""Compare queries with their oracle SQL.

    python tests/oracle_check.py [--sf DIR] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=lambda t: tuple((v is None, str(type(v)), v if v is not None else 0) for v in t))


def compare(df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs. Types count as well."""
    got_names, got = _rows(df.columns, [tuple(x) for x in df.collect()])
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first {bad[0][0]} != {bad[0][1]}"
    return None


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from __spark_entry__ import oracle_sql, queries
    from costlens.session import build_session

    spark = build_session("oracle-check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    oracles = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        begin = time.time()
        try:
            df = fn(spark, args.sf)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = f"{df.count()} rows" if problem is None and "-v" in sys.argv else ""
            else:
                problem, note = None, f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:700]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - begin:.1f}s {note} {problem or ''}", flush=True)
    print(f"failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
