"""Runs queries beside their SQL, as the driver does: ``python tests/compare.py [sf] [name...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if value != value else round(value, 9) + 0.0
    return value


def rows_of(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What is different between a DataFrame and the SQL's result; empty if nothing is."""
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(names):
        return [f"columns {sorted(got_names)} and {sorted(names)}"]
    a, b = rows_of(got, got_names), rows_of(want, names)
    out = [] if len(a) == len(b) else [f"{len(a)} and {len(b)} rows"]
    out += [f"{x} and {y}" for x, y in zip(a, b, strict=False) if x != y][:3]
    types = {n: {type(r[k]).__name__ for r in got if r[k] is not None} for k, n in enumerate(got_names)}
    kinds = {n: {type(r[k]).__name__ for r in want if r[k] is not None} for k, n in enumerate(names)}
    return out + [f"types of {n}: {types[n]} and {kinds[n]}" for n in names if types[n] != kinds[n]]


def main(args: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/{args[0] if args else 'sf0.001'}"
    spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, queries, sql, bad = duck(sf_dir), entry.queries(), entry.oracle_sql(), 0
    for name in args[1:] or queries:
        began = time.time()
        try:
            found = differences(queries[name](spark, sf_dir), con, sql[name]) if name in sql else [] if queries[name](spark, sf_dir).count() >= 0 else ["no rows"]
        except Exception as e:
            found = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(found)
        print("ok  " if not found else "BAD ", name, "" if name in sql else "(no SQL)", f"{time.time() - began:.1f} s", *found, sep=" ", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
