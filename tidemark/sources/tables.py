"""Scans of bronze and silver tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidemark.spec import ScdSpec

BUFFER = "_extract_buffer_id"


def buffer_rows(bronze: DataFrame, buffers: str | Iterable[str], load_dates: Iterable[tuple] | None = None) -> DataFrame:
    """Rows of one or more extract buffers; with the load dates given, only those partitions are listed."""
    buffers = [buffers] if isinstance(buffers, str) else list(buffers)
    rows = bronze.where(F.col(BUFFER).isin(*buffers))
    if load_dates is not None:
        wanted = F.lit(False)
        for year, month, day in load_dates:
            wanted = wanted | ((F.col("_year") == year) & (F.col("_month") == month) & (F.col("_day") == day))
        rows = rows.where(wanted)
    return rows


def buffer_summary(bronze: DataFrame, spec: ScdSpec) -> DataFrame:
    """Row count and sequence range per extract buffer, as write registrations carry them."""
    return bronze.groupBy(BUFFER).agg(
        F.count(F.lit(1)).alias("write_row_count"),
        F.min(spec.order_col).alias("source_min_lsn"),
        F.max(spec.order_col).alias("source_max_lsn"),
    )
