"""Splitting hot keys so that no window group holds an unbounded share of the rows.

A window over ``key`` puts a whole key into one task. Keys too large for that are found by counting,
range-partitioned by ``(key, order)`` into chunks, and worked on per ``(key, chunk)``. What crosses
a chunk boundary is carried over a small relation with a few rows per chunk.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.scratch import written
from tidemark.spec import RECORD_COUNT, RECORD_NUMBER, ScdSpec

CHUNK = "_chunk"

# Relations with a few rows per chunk and hot key are broadcast only up to so many rows.
BROADCAST_ROWS = 500_000

#: Rows of a chunk, about, at most: a chunk is sorted by one task, so it must not grow with the hot keys.
CHUNK_ROWS = 500_000
_PLACE = "_place"


def key_hash(keys) -> Column:
    return F.xxhash64(*(F.col(k) for k in keys))


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys (a written table), their number, and the number of chunks their rows fill."""

    hashes: DataFrame
    keys: int
    chunks: int

    def rows(self, df: DataFrame, keys) -> DataFrame:
        return self._split(df, keys, "left_semi")

    def others(self, df: DataFrame, keys) -> DataFrame:
        return self._split(df, keys, "left_anti")

    def _split(self, df: DataFrame, keys, how: str) -> DataFrame:
        hashes = F.broadcast(self.hashes) if self.keys <= BROADCAST_ROWS else self.hashes
        return df.withColumn("_hash", key_hash(keys)).join(hashes, "_hash", how).drop("_hash")

    def small(self, df: DataFrame) -> DataFrame:
        """A relation of at most three rows per chunk and hot key, marked for broadcast if that is few."""
        return F.broadcast(df) if 3 * (self.chunks + self.keys) <= BROADCAST_ROWS else df

    def chunked(self, rows: DataFrame, keys, *order: str) -> DataFrame:
        """The hot rows, stored with a chunk number that rises along ``(key, order)``.

        Stored, because the range bounds come from sampling: all later reads must see the same chunks.
        """
        spread = rows.repartitionByRange(self.chunks, *keys, *order)
        return written(spread.withColumn(CHUNK, F.spark_partition_id()))

    def placed(self, rows: DataFrame, keys, *order: str) -> DataFrame:
        """As ``chunked``, with each row's place in its chunk by ``(key, order)``: sorted where it is, without another exchange."""
        spread = rows.repartitionByRange(self.chunks, *keys, *order).sortWithinPartitions(*keys, *order)
        place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its low bits count the rows of a partition
        return written(spread.withColumns({CHUNK: F.spark_partition_id(), _PLACE: place}))


def find_hot_keys(inputs: DataFrame | list[DataFrame], keys, spec: ScdSpec) -> HotKeys | None:
    """Keys with more than ``spec.hot_rows`` rows in the union of the inputs, or None.

    Rows are counted first, which reads no column of a parquet scan; only inputs with enough of them are counted by
    key, on a hash of it and combined before the shuffle. Hash collisions merely make a further key count as hot, which
    changes where its rows are processed but not what comes out.
    """
    inputs = [inputs] if isinstance(inputs, DataFrame) else inputs
    hashes = reduce(DataFrame.union, (df.select(key_hash(keys).alias("_hash")) for df in inputs))
    if hashes.count() <= spec.hot_rows:
        return None
    counted = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    hot = written(counted.where(F.col("_rows") > spec.hot_rows))
    found = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_rows").alias("rows")).first()
    if not found["keys"]:
        return None
    return HotKeys(hot.select("_hash"), found["keys"], max(2, -(-found["rows"] // min(spec.hot_rows, CHUNK_ROWS))))


def null_safe(left: DataFrame, right: DataFrame, names) -> Column:
    return reduce(and_, (left[n].eqNullSafe(right[n]) for n in names))


def with_ordinals(
    df: DataFrame,
    keys,
    order,
    spec: ScdSpec,
    number: str = RECORD_NUMBER,
    count: str = RECORD_COUNT,
) -> DataFrame:
    """Position of each row in its key by ``order`` (unique within the key), and the key's size."""
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order)
    hot = find_hot_keys(df, keys, spec)
    if hot is None:
        return local_ordinals(df, keys, order, number, count)
    cold = local_ordinals(hot.others(df, keys), keys, order, number, count)
    placed = hot.placed(hot.rows(df, keys), keys, *order)
    counts = placed.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows"), F.min(_PLACE).alias("_first"))
    offsets = chunk_offsets(counts, keys, "_first")
    offsets = offsets.withColumn("_before", F.col("_before") - F.col("_first")).drop("_first")
    local = placed.withColumns({number: F.col(_PLACE) + 1, count: F.lit(0)}).drop(_PLACE)
    return cold.unionByName(add_offsets(local, hot.small(offsets), keys, number, count).select(*cold.columns))


def local_ordinals(df: DataFrame, group, order, number: str, count: str) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns(
        {number: F.row_number().over(ordered), count: F.count(F.lit(1)).over(whole).cast("int")}
    )


def chunk_offsets(chunks: DataFrame, keys, *more: str) -> DataFrame:
    """Rows before each chunk and in its whole key, from one ``_rows`` count per chunk; further columns ``more`` stay.

    A chunk spans few keys and a key few chunks, so this relation has at most chunks + hot keys rows.
    """
    ordered = Window.partitionBy(*keys).orderBy(CHUNK)
    before = F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    whole = F.sum("_rows").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return chunks.select(*keys, CHUNK, *more, F.coalesce(before, F.lit(0)).alias("_before"), whole.alias("_all"))


def add_offsets(local: DataFrame, offsets: DataFrame, keys, number: str, count: str) -> DataFrame:
    joined = local.join(offsets, null_safe(local, offsets, [*keys, CHUNK]), "inner")
    kept = [local[c] for c in local.columns if c not in (number, count, CHUNK)]
    return joined.select(
        *kept,
        (local[number] + offsets["_before"]).cast("int").alias(number),
        offsets["_all"].cast("int").alias(count),
    )
