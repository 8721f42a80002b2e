"""Run registered queries and their SQL side by side.

    python -m tests.oracle sf0.01 [name-prefix ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def plain(value):
    """Comparable form of a cell; kinds stay apart, widths of numbers do not."""
    if value is None:
        return ("null", "")
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value + 0.0)
    if isinstance(value, datetime.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if isinstance(value, dict):
        return ("map", tuple(sorted((k, plain(v)) for k, v in value.items())))
    return (type(value).__name__, str(value))


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(plain(r[n]) for n in names) for r in df.select(*names).collect())


def duck_rows(db, sql):
    result = db.execute(sql)
    have = [d[0] for d in result.description]
    order = sorted(range(len(have)), key=lambda i: have[i])
    rows = sorted(tuple(plain(r[i]) for i in order) for r in result.fetchall())
    return sorted(have), rows


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def differences(df, db, sql) -> str:
    """Empty when both sides agree exactly, in names, types and values."""
    names, ours = spark_rows(df)
    their_names, theirs = duck_rows(db, sql)
    if names != their_names:
        return f"columns {names} vs {their_names}"
    types = {c: SQL_TYPES.get(t, t) for c, t in df.dtypes}
    their_types = {c[0]: str(c[1]) for c in db.execute(f"DESCRIBE {sql}").fetchall()}
    if types != their_types:
        return f"types {types} vs {their_types}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        a, b = wrong[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(wrong)} of {len(ours)} rows differ, first: {str(cells)[:600]}"
    return ""


def main(scale: str, *prefixes: str) -> int:
    from marlstone.plans import load
    from marlstone.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/{scale}"
    db = connect(folder)
    bad = 0
    for name, q in load().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            if q.sql is None:
                result = f"rows {df.count()} (no SQL)"
            else:
                result = differences(df, db, q.sql) or f"ok {df.count()} rows"
        except Exception as e:  # report and go on
            result = f"ERROR {type(e).__name__}: {str(e)[:700]}"
        failed = not (result.startswith("ok") or result.startswith("rows"))
        bad += failed
        print(f"{'BAD ' if failed else '    '}{name:34s} {time.time() - start:6.2f}s  {result}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
