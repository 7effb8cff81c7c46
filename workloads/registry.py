"""Collects queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import utc_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_millis(stamp: Column) -> Column:
    """Milliseconds since 1970 of a wall-clock timestamp, independent of the session time zone."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), stamp)


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as text, so that a result does not depend on session time zone or client limits."""
    columns = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *(
            utc_text(F.col(c), types[c]).alias(c)
            if isinstance(types[c], (T.TimestampType, T.TimestampNTZType))
            else F.col(c)
            for c in columns
        )
    )
