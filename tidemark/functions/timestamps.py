"""Timestamp conversion and load-date columns of the bronze layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.spec import TRANSFORMED_AT

# Columns to convert and the text pattern of change-event stamps ('Z' is read as UTC).
TIMESTAMP_SUFFIXES = ("_created_at", "_updated_at")
TIMESTAMP_NAMES = ("_extracted_at",)
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]X"


def is_timestamp_name(name: str) -> bool:
    return name.endswith(TIMESTAMP_SUFFIXES) or name in TIMESTAMP_NAMES


def parse_iso(column: Column) -> Column:
    """Parse ``2026-05-31T02:27:24[.242870]Z``; anything else is null, never an error."""
    return F.when(column.endswith("Z"), F.try_to_timestamp(column, F.lit(ISO_PATTERN)))


def convert_timestamps(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            parse_iso(F.col(f"`{f.name}`")).alias(f.name)
            if is_timestamp_name(f.name) and isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def with_load_date(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    loaded_at = F.current_timestamp() if loaded_at is None else loaded_at
    return df.withColumns(
        {"_year": F.year(loaded_at), "_month": F.month(loaded_at), "_day": F.dayofmonth(loaded_at)}
    )


def with_transformed_at(df: DataFrame) -> DataFrame:
    return df.withColumn(TRANSFORMED_AT, F.current_timestamp())
