"""Run named queries on Spark and their oracle on DuckDB, and compare the rows.

    python tests/compare.py [--sf 0.01] [name-part ...]
"""

from __future__ import annotations

import argparse
import datetime
import math
import os
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = pathlib.Path(os.environ.get("TESTDATA", "/root/testdata"))


def spark_session(cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weirgauge-checks")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 9) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(([cell(r[k]) for k in order] for r in rows), key=repr)


KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def compare(con, df, sql):
    """None if equal, else a text that shows the first difference."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    right = rows_of(names, expected.fetchall())
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}; {left[:2]} / {right[:2]}"
    for a, b in zip(left, right):
        if a != b:
            return f"columns {sorted(names)}\n    spark  {a}\n    duckdb {b}"
    types = {d[0]: str(d[1]) for d in expected.description}
    off = [
        f"{n}: {t} / {types[n]}"
        for n, t in df.dtypes
        if KIND.get(t, t) != types[n] and types[n] not in ("NUMBER", "STRING")
    ]
    return f"TYPES {off}" if off and os.environ.get("STRICT_TYPES") else None


def main():
    import __spark_entry__ as entry

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("parts", nargs="*")
    args = args.parse_args()
    sf_dir = str(DATA / f"sf{args.sf}")
    spark, con = spark_session(), database(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if args.parts and not any(p in name for p in args.parts):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                trouble = compare(con, df, oracles[name])
            else:
                trouble = None if df.collect() else "no rows"
        except Exception as e:
            trouble = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += trouble is not None
        mark = "ok  " if trouble is None else "BAD "
        kind = "" if name in oracles else " (rows only)"
        print(f"{mark} {name}{kind} {time.time() - started:.1f}s", trouble or "", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
