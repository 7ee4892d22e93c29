"""Runs registered queries against their SQL twins.

    python tests/compare.py [sf] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Spark type name -> the type the SQL twin must have.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What is different between a DataFrame and the result of a SQL text."""
    result = con.execute(sql)
    want_types = {c[0]: str(c[1]) for c in result.description}
    got_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if set(want_types) != set(got_types):
        return [f"columns {sorted(got_types)} instead of {sorted(want_types)}"]
    want_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    found += [
        f"{name} is {got_types[name]} instead of {want_types[name]}"
        for name in sorted(got_types) if got_types[name] != want_types[name]
    ]
    want = _rows(list(want_types), con.execute(sql).fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got != want:
        found.append(f"{sum(got.values())} rows instead of {sum(want.values())}")
        found.append(f"only here: {list((got - want).items())[:3]}")
        found.append(f"missing: {list((want - got).items())[:3]}")
    return found


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        found = differences(query(spark, sf_dir), con, sql[name]) if name in sql else ["no SQL"]
        bad += bool(found)
        print(f"{name:36s} {time.time() - start:6.2f}s  {'; '.join(found) or 'equal'}", flush=True)
    print(f"{bad} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
