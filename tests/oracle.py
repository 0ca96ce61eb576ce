"""Runs registered queries beside their SQL; also a command: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from barline.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


SAME_TYPE = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """One form for equal values of either engine."""
    if value is None or isinstance(value, (str, bool)):
        return repr(value)
    number = float(value)
    if math.isnan(number):
        return "nan"
    return repr(round(number, 6) + 0.0)


def compare(spark, con, sf_dir: str, name: str) -> tuple[str, float, float, int]:
    """('' or what differs, Spark seconds, DuckDB seconds, rows)."""
    started = time.time()
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    spark_time = time.time() - started
    sql = oracle_sql().get(name)
    if sql is None:
        return ("" if got else "no rows"), spark_time, 0.0, len(got)
    started = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}", spark_time, 0.0, len(got)
    at = [names.index(c) for c in columns]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for name_, kind, *_ in cursor.description:
        if SAME_TYPE.get(str(kind)) != kinds[name_]:
            return f"{name_} is {kinds[name_]} against {kind}", spark_time, 0.0, len(got)
    want = sorted(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())
    sql_time = time.time() - started
    if got == want:
        return ("" if got else "no rows"), spark_time, sql_time, len(got)
    extra, missing = set(got) - set(want), set(want) - set(got)
    return (
        f"{columns}: {len(got)} rows against {len(want)}, {len(extra)} only here, e.g."
        f" {sorted(extra)[:2]}, {len(missing)} only there, e.g. {sorted(missing)[:2]}"
    ), spark_time, sql_time, len(got)


if __name__ == "__main__":
    sf_dir = f"/root/testdata/{sys.argv[1] if len(sys.argv) > 1 else 'sf0.01'}"
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or queries():
        try:
            fault, a, b, n = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            fault, a, b, n = f"{type(error).__name__}: {str(error)[:600]}", 0, 0, 0
        bad += bool(fault)
        print(f"{'FAIL' if fault else 'ok':4} {name:24} {n:7} rows {a:6.2f}s {b:6.2f}s {fault[:900]}", flush=True)
    print(f"{bad} failed")
