"""Run registered queries next to their SQL in DuckDB: ``python tests/compare.py [sf] [name ...]``."""

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted("\x01".join(_cell(row[i]) for i in order) for row in rows)


def mismatch(spark, con, name, sf_dir):
    """None when both sides agree, else a description."""
    df = queries()[name](spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(oracle_sql()[name])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    different = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(different)} rows differ, first:\n  {different[0][0]!r}\n  {different[0][1]!r}" if different else None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf, *names = sys.argv[1:] or ["0.001"]
    sf_dir = f"/root/testdata/sf{sf}"
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names or queries():
        started = time.time()
        try:
            if name in oracle_sql():
                n = con.execute(f"SELECT count(*) FROM ({oracle_sql()[name]})").fetchone()[0]
                problem = mismatch(session, con, name, sf_dir)
            else:
                n, problem = queries()[name](session, sf_dir).count(), "no oracle"
        except Exception as error:
            n, problem = -1, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {n} rows {time.time() - started:.1f}s {problem or ''}", flush=True)
