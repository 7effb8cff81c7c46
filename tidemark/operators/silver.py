"""Type 1, reads of the history, keyed upserts and backfills of older silver tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import version_key
from tidemark.spec import (
    IS_CURRENT,
    IS_DELETED,
    LAST_SEEN,
    RECORD_COUNT,
    RECORD_NUMBER,
    TYPE1_DROPPED,
    VALID_FROM,
    VALID_TO,
    VERSION_KEY,
    ScdSpec,
)


def derive_type1(type2: DataFrame, spec: ScdSpec) -> DataFrame:
    """Latest state per key from any type-2 rows, deletes kept as rows marked deleted.

    ``row_number = 1`` lets Spark keep only each task's best row per key before the shuffle.
    """
    newest = Window.partitionBy(*spec.keys).orderBy(F.col(spec.order_col).desc())
    return (
        type2.where(F.col(IS_CURRENT) | F.col(IS_DELETED))
        .withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1")
        .drop("_rn", *TYPE1_DROPPED)
    )


def type1_of_complete(type2: DataFrame) -> DataFrame:
    """The same for type-2 rows that hold whole keys: the last record of each key. No shuffle."""
    return type2.where(F.col(RECORD_NUMBER) == F.col(RECORD_COUNT)).drop(*TYPE1_DROPPED)


def as_of(type2: DataFrame, moment: Column | str) -> DataFrame:
    """Versions whose validity holds the moment. A filter, so no shuffle."""
    if isinstance(moment, str):
        moment = F.lit(moment).cast(type2.schema[VALID_FROM].dataType)
    return type2.where((F.col(VALID_FROM) <= moment) & (moment <= F.col(VALID_TO)))


def refuse_repeated(source: DataFrame, keys) -> DataFrame:
    """``source``, failing when it runs if a key has several rows: a merge could not tell which of them counts.

    Null keys match nothing, so they may repeat. The count shares the merge's exchange.
    """
    present = reduce(and_, (F.col(k).isNotNull() for k in keys))
    why = F.concat(F.lit("several source rows for the key "), F.to_json(F.struct(*keys)))
    counted = source.withColumn("_copies", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    single = F.when(present & (F.col("_copies") > 1), F.raise_error(why).cast("boolean")).otherwise(F.lit(True))
    return counted.where(single).drop("_copies")


def merge_upsert(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Keyed merge: source rows replace or join target rows; one exchange on the key.

    Columns only the target has keep their values in matched rows; columns only the source has are added. Several source
    rows for one key are an error.
    """
    keys = list(keys)
    source = refuse_repeated(source, keys)
    kept_columns = [c for c in target.columns if c not in source.columns]
    if not kept_columns:
        untouched = target.join(source.select(*keys), keys, "left_anti")
        return untouched.unionByName(source, allowMissingColumns=True)
    old, new = target.alias("old"), source.withColumn("_incoming", F.lit(True)).alias("new")
    condition = reduce(and_, (F.col(f"old.`{k}`") == F.col(f"new.`{k}`") for k in keys))
    incoming = F.col("new._incoming").isNotNull()

    def value(name: str) -> Column:
        if name not in target.columns:
            return F.col(f"new.`{name}`")
        if name not in source.columns:
            return F.col(f"old.`{name}`")
        return F.when(incoming, F.col(f"new.`{name}`")).otherwise(F.col(f"old.`{name}`"))

    names = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    return old.join(new, condition, "full_outer").select(*(value(n).alias(n) for n in names))


def ensure_is_deleted(silver: DataFrame) -> DataFrame:
    flag = F.coalesce(F.col(IS_DELETED), F.lit(False)) if IS_DELETED in silver.columns else F.lit(False)
    return silver.withColumn(IS_DELETED, flag)


def ensure_version_key(silver: DataFrame) -> DataFrame:
    made = version_key(silver.schema[VALID_FROM].dataType)
    if VERSION_KEY in silver.columns:
        made = F.coalesce(F.col(VERSION_KEY), made)
    return silver.withColumn(VERSION_KEY, made)


def ensure_layout(silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """An older type-2 table with every column of today's layout; unknown sequence marks stay null."""
    filled = ensure_version_key(ensure_is_deleted(silver))
    if LAST_SEEN not in filled.columns:
        order_type = filled.schema[spec.order_col].dataType
        filled = filled.withColumn(LAST_SEEN, F.lit(None).cast(order_type))
    return filled
