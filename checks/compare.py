"""Runs queries in Spark and their SQL in DuckDB and compares whole results.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import oracle_sql
from checks.queries import QUERIES


def session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("crewlens")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # The widest job alone generates more than the default 100 classes.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # The JVM never compiles a method above 8000 bytes of bytecode; Spark then splits it up.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


# Spark type to the type DuckDB must report.
_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("\0" if row[i] is None else str(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str | None:
    """None when columns, types and all rows are equal, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    result = con.execute(oracle_sql()[name])
    want_types = {c[0]: str(c[1]) for c in result.description}
    got_types = {c: _TYPES.get(t, t.upper()) for c, t in df.dtypes}
    if got_types != want_types:
        return f"types differ: {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    want = _canonical(list(want_types), result.fetchall())
    got = _canonical(df.columns, [tuple(row) for row in df.collect()])
    if got == want:
        return None
    only_got, only_want = sorted(set(got) - set(want))[:3], sorted(set(want) - set(got))[:3]
    return f"rows {len(got)} vs {len(want)}; only Spark {only_got}; only SQL {only_want}"


def main(sf_dir: str, names: list[str]) -> int:
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        difference = compare(spark, con, name, sf_dir)
        bad += difference is not None
        print(f"{'ok  ' if difference is None else 'DIFF'} {name} {time.time() - start:.1f}s {difference or ''}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
