"""Runs registered queries against DuckDB on the same files: ``python tests/check.py [sf_dir] [names...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle(sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def difference(spark_df, connection, sql):
    """None if both results hold the same rows, else a description."""
    got_rows = [tuple(r) for r in spark_df.collect()]
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    at = [spark_df.columns.index(n) for n in names]
    got = sorted((repr(tuple(_plain(r[i]) for i in at)) for r in got_rows))
    want = sorted(repr(tuple(_plain(v) for v in r)) for r in want_rows)
    if got == want:
        return None
    extra = sorted(set(got) - set(want))[:2]
    missing = sorted(set(want) - set(got))[:2]
    return f"{len(got)} rows against {len(want)}; only here {extra}; only there {missing}"


def _plain(value):
    import decimal

    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(entry.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            sql = entry.oracle_sql().get(name)
            problem = difference(df, connection, sql) if sql else f"no SQL; {df.count()} rows"
        except Exception as error:  # noqa: BLE001 - reported per query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None and not problem.startswith("no SQL")
        print(f"{'ok ' if problem is None else '-- '}{name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(names)} queries, {bad} wrong")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
