"""Run the queries in Spark and their SQL in DuckDB and compare the answers.

python -m verification.compare [folder] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb

SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "BOOLEAN": "boolean", "DATE": "date",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def open_database(folder):
    database = duckdb.connect()
    database.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{folder}/{table}.parquet").exists():
            database.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    return database


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def difference(answer, database, sql):
    """None if both sides agree, else a short description."""
    expected = database.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: SPARK_TYPES.get(str(d[1]), str(d[1])) for d in expected.description}
    if kinds != dict(answer.dtypes):
        return f"types {answer.dtypes} != {kinds}"
    want_columns, want = _canonical(names, expected.fetchall())
    got_columns, got = _canonical(answer.columns, [tuple(r) for r in answer.collect()])
    if want_columns != got_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(want) != len(got):
        return f"{len(got)} rows != {len(want)}"
    for mine, theirs in zip(got, want):
        same_types = all(a is None or b is None or type(a) is type(b) for a, b in zip(mine, theirs))
        if mine != theirs or not same_types:
            return f"{mine} != {theirs}"
    return None


def main(folder="/root/testdata/sf0.01", *names):
    from pyspark.sql import SparkSession

    from .oracles import ORACLES
    from .queries import QUERIES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    database = open_database(folder)
    failed = []
    for name in names or QUERIES:
        start = time.time()
        problem = difference(QUERIES[name](spark, folder), database, ORACLES[name])
        print(f"{name:26} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
        failed += [name] if problem else []
    print(f"{len(failed)} failed: {failed}" if failed else "all agree")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
