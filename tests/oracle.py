"""Compares a query's Spark result with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewell.plans.registry import TABLES  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def normal(value):
    """Values in a form both engines share; numbers of different types stay different."""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    if hasattr(value, "asDict"):
        value = value.asDict()
    if isinstance(value, dict):
        return tuple(sorted((k, normal(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([normal(r[i]) for i in order] for r in rows), key=repr)


SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "DATE": "date",
}


def type_differences(df, con, sql):
    """Columns whose types differ between the two engines."""
    described = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} <> {described.get(name)}"
        for name, kind in df.dtypes
        if SPARK_TYPES.get(described.get(name)) != kind
    ]


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} <> {sorted(names)}"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(expected):
        return f"{len(got)} rows <> {len(expected)}"
    for a, b in zip(got, expected):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{sorted(names)}: {a} <> {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry_point
    from tidewell.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    wanted = sys.argv[1:]
    spark = build_session(
        "check", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                              "spark.driver.memory": "12g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry_point.oracle_sql()
    bad = 0
    for name, run in entry_point.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
                types = type_differences(df, con, sqls[name])
                state = f"ok {types or ''}" if problem is None else f"DIFF {problem[:600]}"
            else:
                state = f"rows only: {df.count()}"
        except Exception as error:  # a broken query is reported like a wrong one
            state = f"ERROR {str(error)[:900]}"
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:36s} {time.time() - start:6.2f}s {state}", flush=True)
    print("bad:", bad)
    spark.stop()
