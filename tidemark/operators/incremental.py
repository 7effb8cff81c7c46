"""Extending the type-2 history by new changes at the cost of what changed.

A key whose new changes all come after everything silver has seen of it is extended from its last version alone: earlier
versions stay as they are, but for the number of versions of their key. A key with any change at or below that point (a replay,
late data, an out-of-order buffer) is rebuilt from bronze, which holds every fact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.scratch import written
from tidemark.operators.versions import events_from_changes, events_from_type2, versions_of
from tidemark.spec import GENERATION, LAST_SEEN, RECORD_COUNT, RECORD_NUMBER, ScdSpec

LATE = "_late"
#: Versions before the one that a key is extended from.
EARLIER = "_earlier"


def key_state(changes: DataFrame, silver: DataFrame | None, spec: ScdSpec) -> DataFrame:
    """The keys a batch of changes touches, one row each: whether the key must be rebuilt, how many versions stay, and, if
    silver tells, the generation of its history. ``silver`` needs no more than the last version of each key."""
    keys = list(spec.keys)
    first = changes.groupBy(*keys).agg(F.min(spec.order_col).alias("_first"))
    if silver is None:
        return first.select(*keys, F.lit(False).alias(LATE), F.lit(0).alias(EARLIER), F.lit(0).cast("bigint").alias(GENERATION))
    generation = F.col(GENERATION) if GENERATION in silver.columns else F.lit(0).cast("bigint")
    tips = last_versions(silver).select(
        *keys, F.col(LAST_SEEN).alias("_last"), (F.col(RECORD_NUMBER) - 1).alias("_kept"), generation.alias(GENERATION),
        F.lit(True).alias("_known"),
    )
    # A known key without a last-seen value comes from an older table layout.
    late = F.coalesce(F.col("_first") <= F.col("_last"), F.col("_known"), F.lit(False))
    joined = first.join(tips, keys, "left").withColumn(LATE, late)
    earlier = F.when(F.col(LATE), 0).otherwise(F.coalesce("_kept", F.lit(0)))
    return joined.select(*keys, LATE, earlier.alias(EARLIER), F.coalesce(GENERATION, F.lit(0)).cast("bigint").alias(GENERATION))


def last_versions(silver: DataFrame) -> DataFrame:
    return silver.where(F.col(RECORD_NUMBER) == F.col(RECORD_COUNT))


def extend_type2(
    state: DataFrame,
    changes: DataFrame,
    silver: DataFrame | None,
    bronze_changes: DataFrame | None,
    spec: ScdSpec,
    generation: int | None = None,
) -> DataFrame:
    """New versions of the touched keys after ``changes``: all of a late key, and of another those from its last one on.

    ``bronze_changes`` is None when the caller knows that no key is late: then bronze is not read at all. With a ``generation``
    given, rows say which one they belong to: a late key begins that one.
    """
    keys = list(spec.keys)
    events = []
    in_order = changes
    if bronze_changes is not None:
        in_order = changes.join(state.where(~F.col(LATE)).select(*keys), keys, "left_semi")
        late = state.where(LATE).select(*keys)
        events.append(events_from_changes(bronze_changes.join(late, keys, "left_semi"), spec))
    events.append(events_from_changes(in_order, spec))
    if silver is not None:
        silver = last_versions(silver).drop(GENERATION)
        extended = silver.join(state.where(~F.col(LATE)).select(*keys), keys, "left_semi")
        events.append(events_from_type2(extended, spec))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events)
    sources = [df for df in (changes, silver, bronze_changes) if df is not None]
    versions = versions_of(union, spec, sources)
    begun = state.select(*keys, EARLIER, F.when(F.col(LATE), F.lit(generation)).otherwise(F.col(GENERATION)).alias(GENERATION))
    numbered = versions.join(begun, keys).withColumns({n: F.col(n) + F.col(EARLIER) for n in (RECORD_NUMBER, RECORD_COUNT)})
    return numbered.select(*versions.columns, *([] if generation is None else [GENERATION]))


def with_new_versions(silver: DataFrame, delta: DataFrame, state: DataFrame, spec: ScdSpec) -> DataFrame:
    """The history after an increment: earlier versions of extended keys stay, with the key's new number of versions."""
    keys, delta = list(spec.keys), written(delta)  # it is read twice
    counts = last_versions(delta).select(*keys, F.col(RECORD_COUNT).alias("_new_count"))
    touched = state.select(*keys, EARLIER).join(counts, keys)
    kept = silver.join(touched, keys, "left").where(F.col(EARLIER).isNull() | (F.col(RECORD_NUMBER) <= F.col(EARLIER)))
    kept = kept.withColumn(RECORD_COUNT, F.coalesce("_new_count", RECORD_COUNT)).select(*silver.columns)
    return kept.unionByName(delta, allowMissingColumns=True)
