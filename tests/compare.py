"""Comparison of the registered queries with their SQL in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def family(kind: str) -> str:
    kind = kind.lower()
    for prefix, name in (
        ("decimal", "decimal"),
        ("timestamp_ntz", "timestamp"),
        ("timestamp", "timestamp"),
        ("varchar", "string"),
    ):
        if kind.startswith(prefix):
            return name
    return {"int": "int32", "integer": "int32"}.get(kind, kind)


def key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b and type(a) is type(b)


def compare(frame, con, sql: str) -> list[str]:
    """Differences in columns, types, row count and values; empty if there are none."""
    names = sorted(frame.columns)
    relation = con.sql(sql)
    kinds = dict(zip(relation.columns, [str(t) for t in relation.types]))
    if sorted(kinds) != names:
        return [f"columns {names} vs {sorted(kinds)}"]
    found = []
    for f in frame.schema.fields:
        if family(f.dataType.simpleString()) != family(kinds[f.name]):
            found.append(f"type of {f.name}: {f.dataType.simpleString()} vs {kinds[f.name]}")
    ours = sorted((tuple(r) for r in frame.select(*names).collect()), key=key)
    quoted = ", ".join(f'"{n}"' for n in names)
    theirs = sorted(con.sql(f"SELECT {quoted} FROM ({sql})").fetchall(), key=key)
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows vs {len(theirs)}")
    differing = [(a, b) for a, b in zip(ours, theirs) if not all(same(x, y) for x, y in zip(a, b))]
    if differing:
        found.append(f"{len(differing)} rows differ, first {differing[0]}")
    if not ours:
        found.append("no rows")
    return found


def main(sf_dir: str, only: list[str]) -> int:
    root = Path(__file__).resolve().parent.parent
    sys.path.insert(0, str(root))
    import __spark_entry__ as entry
    from innmetrics.session import local_session

    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), 0
    oracles = entry.oracle_sql()
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            found = compare(build(spark, sf_dir), con, oracles[name]) if name in oracles else ["no sql"]
        except Exception as problem:
            found = [f"{type(problem).__name__}: {str(problem)[:700]}"]
        bad += bool(found)
        print(f"{'ok ' if not found else 'BAD'} {name} {time.time() - started:.1f}s {'; '.join(found)[:1200]}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
