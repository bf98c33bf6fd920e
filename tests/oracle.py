"""Run registered queries against their SQL in DuckDB. `python -m tests.oracle [sf] [name ...]`."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from streamtab.catalog import QUERIES, SQL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "<null>"
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _kind(spark_type: str) -> str:
    return {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}.get(spark_type, spark_type)


def compare(spark, con, folder: str, name: str) -> str | None:
    """None when rows, names and types agree, else what differs."""
    out = QUERIES[name](spark, folder)
    got = _rows(out.columns, out.collect())
    if name not in SQL:
        return None if got else "no rows"
    want = con.sql(SQL[name])
    if sorted(out.columns) != sorted(want.columns):
        return f"columns {sorted(out.columns)} / {sorted(want.columns)}"
    mine = {f.name: _kind(f.dataType.simpleString()) for f in out.schema.fields}
    theirs = {c: str(t) for c, t in zip(want.columns, want.types)}
    if mine != theirs:
        return f"types {mine} / {theirs}"
    expected = _rows(want.columns, want.fetchall())
    if got != expected:
        extra = [r for r in got if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(got)][:3]
        return f"{len(got)} rows / {len(expected)}; extra {extra} missing {missing}"
    return None if got else "agrees but empty"


def main() -> None:
    from streamtab.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    folder = f"/root/testdata/sf{sf}"
    con = duck(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, folder, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error).split("JVM stacktrace")[0][-900:]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {'' if name in SQL else '(rows only)'} {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")


if __name__ == "__main__":
    main()
