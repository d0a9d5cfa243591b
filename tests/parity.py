"""Run queries next to their check statements and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0)
    return "∅" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql) -> str:
    """Empty text when equal, else a short description of the difference."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    odd = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields if not same_kind(f.dataType.simpleString(), kinds[f.name])]
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    if mine != theirs:
        bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
        cols = sorted(names)
        first = [(cols[i], x, y) for i, (x, y) in enumerate(zip(*bad[0])) if x != y][:6]
        return f"{len(bad)} of {len(mine)} rows differ, first: {first}"
    return f"types {odd}" if odd else ""


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


def same_kind(spark_kind: str, duck_kind: str) -> bool:
    return KINDS.get(spark_kind, spark_kind) == duck_kind or duck_kind in ("NULL",)


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from ventaria.session import local_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = local_session(cores=8)
    con = connect(folder)
    sqls = oracle_sql()
    failed = 0
    for name, build in queries().items():
        if wanted and not any(name == w or name.startswith(w.rstrip("*")) and w.endswith("*") for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            text = compare(df, con, sqls[name]) if name in sqls else f"no sql, {df.count()} rows"
        except Exception as error:  # report and go on with the next query
            text = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += bool(text)
        print(f"{'ok ' if not text else 'BAD'} {name} {time.time() - start:.1f}s {text}", flush=True)
    print("failed", failed)
