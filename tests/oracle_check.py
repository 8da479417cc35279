"""Compare registered queries with their SQL: python -m tests.oracle_check [sf_dir] [key ...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def kind(type_name: str) -> str:
    name = type_name.lower()
    for group, words in {
        "int": ("int", "long", "short"),
        "float": ("double", "float", "decimal"),
        "text": ("varchar", "string"),
        "bool": ("bool",),
        "date": ("date",),
    }.items():
        if any(w in name for w in words):
            return group
    return name


def compare(spark, con, name, query, sql, sf_dir) -> str:
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    kinds = {d[0]: kind(str(d[1])) for d in result.description}
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns differ: only spark {set(got_columns) - set(want_columns)}, only sql {set(want_columns) - set(got_columns)}"
    mine = {f.name: kind(f.dataType.typeName()) for f in df.schema.fields}
    off = {c: (mine[c], kinds[c]) for c in mine if mine[c] != kinds[c]}
    if off:
        return f"types differ: {off}"
    if len(got) != len(want):
        return f"row counts differ: spark {len(got)}, sql {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_columns, g, w) if a != b]
        return f"{len(bad)} rows differ, first: {cells}"
    return f"ok {len(got)}" if got else "EMPTY"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from loanseason.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    keys = args[1:] or list(entry.queries())
    spark, con = local_session(8), duck(sf_dir)
    failures = 0
    for key in keys:
        start = time.time()
        try:
            if key in entry.oracle_sql():
                outcome = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], sf_dir)
            else:
                outcome = f"ok rows-only {entry.queries()[key](spark, sf_dir).count()}"
        except Exception as error:  # report and go on to the next key
            outcome = f"error {type(error).__name__}: {str(error)[:600]}"
        failures += not outcome.startswith("ok")
        print(f"{key:24s} {time.time() - start:6.1f}s {outcome}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    raise SystemExit(main())
