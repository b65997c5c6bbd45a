"""Run every query next to its SQL and compare rows: ``python tests/check_queries.py [dir] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "documents pages conversations benchmark labels embeddings".split()


def connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, directory, query, sql):
    """None when equal, else a short description of the difference."""
    df = query(spark, directory)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    other = rows_of(relation.columns, relation.fetchall())
    if mine[0] != other[0]:
        return f"columns {mine[0]} / {other[0]}"
    kinds = {n: t for n, t in zip(relation.columns, map(str, relation.types))}
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    wrong = {n: (spark_kinds[n], kinds[n]) for n in kinds if same.get(spark_kinds[n]) != kinds[n]}
    if wrong:
        return f"types {wrong}"
    if mine[1] == other[1]:
        return None
    a, b = set(map(repr, mine[1])), set(map(repr, other[1]))
    return f"{len(mine[1])} / {len(other[1])} rows; only here {sorted(a - b)[:2]}; only there {sorted(b - a)[:2]}"


def main(directory="/root/testdata/sf0.01", *names):
    import __spark_entry__ as entry
    from tests.conftest import session

    spark, con, bad = session(), connection(directory), 0
    checks = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in checks:
                problem = compare(spark, con, directory, query, checks[name])
            else:
                problem = None if query(spark, directory).count() else "no rows"
        except Exception as e:  # keep going: this is a report
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name:22} {'sql' if name in checks else 'rows'} "
              f"{time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
