"""Compare registered queries with their SQL on the same tables.

Usage: python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 4)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted((tuple(comparable(row[n]) for n in order) for row in rows), key=repr)


def differences(spark: SparkSession, connection, sf_dir: str, name: str) -> list[str]:
    frame = REGISTRY[name](spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if name not in ORACLE:
        return [] if got else ["no rows"]
    result = connection.sql(ORACLE[name])
    expected = rows_of(result.columns, result.fetchall())
    found = []
    if sorted(frame.columns) != sorted(result.columns):
        found.append(f"columns {sorted(frame.columns)} != {sorted(result.columns)}")
    if len(got) != len(expected):
        found.append(f"{len(got)} rows != {len(expected)}")
    off = [(a, b) for a, b in zip(got, expected) if a != b]
    if off:
        found.append(f"{len(off)} rows differ, first: {str(off[0][0])[:700]} != {str(off[0][1])[:700]}")
    floats = {type(v) for row in got for v in row}, {type(v) for row in expected for v in row}
    if floats[0] != floats[1]:
        found.append(f"types {floats[0]} != {floats[1]}")
    return found


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failed = 0
    for name in argv[1:] or REGISTRY:
        start = time.time()
        try:
            found = differences(spark, connection, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:500]}"]
        failed += bool(found)
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else "")
    print(f"{failed} failed; without SQL: {sorted(set(REGISTRY) - set(ORACLE))}; unused SQL: {sorted(set(ORACLE) - set(REGISTRY))}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
