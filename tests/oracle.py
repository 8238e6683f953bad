"""Compare a registered query with its SQL in DuckDB. Usage: python -m tests.oracle <sf_dir> [name | @module ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


TYPES = {
    "bigint": ("BIGINT",), "int": ("INTEGER",), "double": ("DOUBLE",), "string": ("VARCHAR",), "boolean": ("BOOLEAN",),
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0 if "-exact" in sys.argv else float(f"{value:.9g}") + 0.0
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir, function, sql):
    """(ok, message)"""
    result = function(spark, sf_dir)
    got_cols, got = rows_of(result.columns, [tuple(r) for r in result.collect()])
    if sql is None:
        return True, f"rows only: {len(got)}"
    cursor = con.execute(sql)
    want_cols, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_cols != want_cols:
        return False, f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}; first {got[:2]} / {want[:2]}"
    different = [(g, w) for g, w in zip(got, want) if g != w]
    if different:
        return False, f"{len(different)} of {len(got)} rows differ; {different[:2]}"
    duck_types = {d[0]: str(d[1]).upper() for d in cursor.description}
    odd = [(c, t, duck_types[c]) for c, t in result.dtypes if duck_types[c] not in TYPES.get(t, (duck_types[c],))]
    return True, f"{len(got)} rows" + (f" types {odd}" if odd else "")


def main() -> int:
    import __spark_entry__ as entry
    from sparkcorpus.session import local_session

    args = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = local_session()
    con = duck(args[0])
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    wanted = []
    for a in args[1:] or list(queries):
        wanted += [n for n, f in queries.items() if f.__module__.endswith(a[1:])] if a.startswith("@") else [a]
    for name in wanted:
        started = time.time()
        try:
            ok, message = compare(spark, con, args[0], queries[name], oracles.get(name))
        except Exception as error:  # report every query
            ok, message = False, f"{type(error).__name__}: {str(error)[:1500]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {message}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
