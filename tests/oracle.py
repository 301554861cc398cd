"""Runs a registered query in Spark and its SQL in DuckDB and compares the rows, order aside."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def _type(name: str) -> str:
    name = name.lower().split("(")[0]
    same = {"varchar": "string", "integer": "int", "hugeint": "hugeint", "timestamp_ntz": "timestamp"}
    return same.get(name, name)


def difference(spark, run, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, otherwise a description of the first difference."""
    df = run(spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    cursor = connect(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: _type(str(d[1])) for d in cursor.description}
    theirs = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wrong = [(c, t, types[c]) for c, t in df.dtypes if _type(t) != types[c]]
    if wrong:
        return f"types {wrong}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    if bad:
        return f"{len(bad)} of {len(ours)} rows differ, first {bad[0][0]} against {bad[0][1]}"
    return None if ours else "EMPTY on both sides"


def main(names: list[str]) -> None:
    from tallyloom.queries import REGISTRY
    from tallyloom.session import local_session

    spark = local_session(8)
    sf_dir = str(ROOT / "sf0.01")
    for name in names or REGISTRY:
        q = REGISTRY[name]
        start = time.perf_counter()
        try:
            if q.sql is None:
                rows = q.run(spark, sf_dir).collect()
                result = f"rows {len(rows)}: {rows[:4]}"
            else:
                result = difference(spark, q.run, q.sql, sf_dir) or "ok"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {type(error).__name__}: {str(error)[:700]}"
        print(f"{time.perf_counter() - start:6.1f}s  {name:28s} {result}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
