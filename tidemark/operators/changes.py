"""Change detection, lineage refresh, delete closing and tombstones against an existing silver table.

These are the single steps of the type-2 rule for a batch with one event per key, as separate operators. The
whole rule, for any batch, is ``versions.build_type2`` and ``incremental.extend_type2``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.keys import deletion_time, primary_key, sentinel, version_key
from tidemark.spec import (
    IS_CURRENT,
    IS_DELETED,
    NATURAL_KEY,
    PRIMARY_KEY,
    RECORD_COUNT,
    RECORD_NUMBER,
    VALID_FROM,
    VALID_TO,
    VERSION_KEY,
    ScdSpec,
)


def current(silver: DataFrame) -> DataFrame:
    return silver.where(F.col(IS_CURRENT))


def closed(silver: DataFrame) -> DataFrame:
    return silver.where(~F.col(IS_CURRENT))


def changed_upserts(upserts: DataFrame, silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """Upserts whose stamp differs from the current row's. A missing stamp equals nothing, so it is a change."""
    names = [*spec.keys, spec.change_col]
    known = current(silver).select(*names)
    return upserts.join(known, names, "left_anti")


def lineage_refresh(upserts: DataFrame, silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """Current rows met by an upsert with their own stamp, with that upsert's lineage and no new version.

    Of several such upserts the one with the highest sequence number counts; it is found by a partial
    aggregate, so repeated snapshots of one row do not multiply it.
    """
    names = [*spec.keys, spec.change_col]
    lineage = spec.lineage_in(upserts.columns)
    order = F.struct(spec.order_col, *spec.arrival_in(upserts.columns))
    latest = upserts.groupBy(*names).agg(F.max_by(F.struct(*lineage), order).alias("_lineage"))
    rows = current(silver).join(latest, names, "inner")
    return rows.select(
        *(F.col("_lineage")[c].alias(c) if c in lineage else F.col(c) for c in silver.columns)
    )


def latest_deletes(deletes: DataFrame, spec: ScdSpec) -> DataFrame:
    """Last delete per key. Rows are cut to one per key before the shuffle."""
    newest = Window.partitionBy(*spec.keys).orderBy(F.col(spec.order_col).desc())
    return deletes.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def tips(silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """Most recent row of each key: its last record, or, in tables without record numbers, the current one."""
    if RECORD_NUMBER in silver.columns and RECORD_COUNT in silver.columns:
        return silver.where(F.col(RECORD_NUMBER) == F.col(RECORD_COUNT))
    recency = Window.partitionBy(*spec.keys).orderBy(F.col(IS_CURRENT).desc(), F.col(spec.order_col).desc())
    return silver.withColumn("_rn", F.row_number().over(recency)).where("_rn = 1").drop("_rn")


def close_deleted(deletes: DataFrame, silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """The most recent silver row of each deleted key, ended at the deletion time.

    It keeps its own image, lineage, sequence number and record numbers. A delete older than the row leaves
    it alone.
    """
    keys = list(spec.keys)
    stamp_type = silver.schema[VALID_TO].dataType
    times = latest_deletes(deletes, spec).select(
        *keys, deletion_time(spec, stamp_type).alias("_ended"), F.col(spec.order_col).alias("_delete_order")
    )
    recent = tips(silver, spec).join(times, keys, "inner").where(
        F.col(spec.order_col) <= F.col("_delete_order")
    )
    replaced = {
        VALID_TO: F.col("_ended"),
        IS_CURRENT: F.lit(False),
        IS_DELETED: F.lit(True),
        RECORD_NUMBER: F.col(RECORD_NUMBER) if RECORD_NUMBER in silver.columns else F.lit(1),
        RECORD_COUNT: F.col(RECORD_COUNT) if RECORD_COUNT in silver.columns else F.lit(1),
    }
    columns = dict.fromkeys([*silver.columns, RECORD_NUMBER, RECORD_COUNT])
    return recent.select(*(replaced.get(c, F.col(c)).alias(c) for c in columns))


def tombstones(deletes: DataFrame, silver: DataFrame | None, spec: ScdSpec) -> DataFrame:
    """Deletes of keys silver does not know, as rows that are current and deleted since the begin of time."""
    unknown = latest_deletes(deletes, spec)
    if silver is not None:
        unknown = unknown.join(tips(silver, spec).select(*spec.keys), list(spec.keys), "left_anti")
    stamp_type = deletes.schema[spec.change_col].dataType
    natural = F.col(spec.keys[0]) if len(spec.keys) == 1 else F.concat_ws("-", *spec.keys)
    return unknown.select(
        "*",
        sentinel(spec.begin_of_time, stamp_type).alias(VALID_FROM),
        deletion_time(spec, stamp_type).alias(VALID_TO),
        F.lit(True).alias(IS_CURRENT),
        F.lit(True).alias(IS_DELETED),
        primary_key(spec).alias(PRIMARY_KEY),
        natural.alias(NATURAL_KEY),
        F.lit(1).alias(RECORD_NUMBER),
        F.lit(1).alias(RECORD_COUNT),
    ).withColumn(VERSION_KEY, version_key(stamp_type))
