"""The silver type-2 rule as one set-based plan.

Facts of a key are its change events by sequence number; of several copies of one event the first to arrive
counts, and of those that arrived alike the one with the smallest hash. Walked in sequence order:

* an upsert opens a version; the version in force ends one microsecond before it;
* an upsert with the stamp of the version in force only refreshes that version's lineage;
* a delete ends the version in force at the deletion time and marks it deleted;
* a delete with nothing before it becomes a tombstone, current until a later upsert;
* a delete after a delete only moves the end.

So neighbouring events of the same kind (two deletes, or two upserts with equal stamps) form one *run*, a run
is one version, and everything else about it follows from the runs next to it. All windows share one
partitioning and one sort order, hence one exchange and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.keys import deletion_time, is_timestamp, just_before, primary_key, sentinel, version_key
from tidemark.operators.flatten import is_delete
from tidemark.operators.scratch import written
from tidemark.operators.skew import CHUNK, HotKeys, add_offsets, chunk_offsets, find_hot_keys, local_ordinals, null_safe
from tidemark.spec import (
    IS_CURRENT,
    IS_DELETED,
    LAST_SEEN,
    NATURAL_KEY,
    PRIMARY_KEY,
    RECORD_COUNT,
    RECORD_NUMBER,
    TYPE2_COLUMNS,
    VALID_FROM,
    VALID_TO,
    VERSION_KEY,
    ScdSpec,
)

# Event and run columns next to the row image. Neighbours' values are plain columns, not structs: that keeps
# the windows, which are most of the work, on primitive values.
DELETES = "_deletes"
ENDS_AT = "_ends_at"
SEEN = "_seen"
TAIL = "_tail"
TIE = "_tie"
HAS_PREVIOUS = "_has_previous"
HAS_NEXT = "_has_next"
NEXT_DELETES = "_next_deletes"
NEXT_STAMP = "_next_stamp"
NEXT_ENDS_AT = "_next_ends_at"
NEXT_SEEN = "_next_seen"
NEXT = (HAS_NEXT, NEXT_DELETES, NEXT_STAMP, NEXT_ENDS_AT, NEXT_SEEN)


def build_type2(changes: DataFrame, spec: ScdSpec) -> DataFrame:
    """Full history of every key in ``changes`` (row images with event metadata)."""
    return versions_of(events_from_changes(changes, spec), spec)


def events_from_changes(changes: DataFrame, spec: ScdSpec) -> DataFrame:
    stamp_type = changes.schema[spec.change_col].dataType
    if not is_timestamp(stamp_type):
        raise ValueError(f"{spec.change_col} must be a timestamp, is {stamp_type.simpleString()}")
    return changes.withColumns(
        {
            DELETES: is_delete(spec),
            ENDS_AT: F.when(is_delete(spec), deletion_time(spec, stamp_type)),
            SEEN: F.col(spec.order_col),
        }
    )


def events_from_type2(silver: DataFrame, spec: ScdSpec) -> DataFrame:
    """Silver rows back as the events that made them: an upsert, a delete, or an upsert and its delete."""
    closed_by_delete = F.col(IS_DELETED) & (F.col(VALID_FROM).isNull() | ~_is_tombstone(silver, spec))
    parts = F.when(closed_by_delete, F.array(F.lit("upsert"), F.lit("delete"))).otherwise(
        F.array(F.when(F.col(IS_DELETED), F.lit("delete")).otherwise(F.lit("upsert")))
    )
    rows = silver.withColumn("_part", F.explode(parts))
    deleting = F.col("_part") == "delete"
    second = deleting & closed_by_delete
    base = [c for c in silver.columns if c not in TYPE2_COLUMNS and c != spec.order_col]
    return rows.select(
        *base,
        F.when(second, F.col(LAST_SEEN)).otherwise(F.col(spec.order_col)).alias(spec.order_col),
        deleting.alias(DELETES),
        F.when(deleting, F.col(VALID_TO)).alias(ENDS_AT),
        F.when(closed_by_delete & ~deleting, F.col(spec.order_col)).otherwise(F.col(LAST_SEEN)).alias(SEEN),
    )


def _is_tombstone(silver: DataFrame, spec: ScdSpec) -> Column:
    """A tombstone is the only row whose own event is a delete."""
    if spec.op_col in silver.columns:
        return F.col(spec.op_col).eqNullSafe(spec.delete_op)
    return F.col(VALID_FROM) == sentinel(spec.begin_of_time, silver.schema[VALID_FROM].dataType)


def versions_of(events: DataFrame, spec: ScdSpec, sources: list[DataFrame] | None = None) -> DataFrame:
    """Versions from events. ``sources`` are the relations the events come from: looking for hot keys there
    spares running the joins between them and the events once more."""
    keys = list(spec.keys)
    hot = find_hot_keys(sources or [events], keys, spec)
    if hot is None:
        return _cold_versions(events, keys, spec)
    cold = _cold_versions(hot.others(events, keys), keys, spec)
    return cold.unionByName(_hot_versions(events, keys, hot, spec).select(*cold.columns))


def _cold_versions(events: DataFrame, keys: list[str], spec: ScdSpec) -> DataFrame:
    rows = _finish(_link(_runs(events, keys, spec), keys, spec), spec)
    return local_ordinals(rows, keys, [spec.order_col], RECORD_NUMBER, RECORD_COUNT)


def _shape(spec: ScdSpec, prefix: str = "") -> dict[str, Column]:
    """What decides whether two neighbouring events belong to one run."""
    return {name: F.col(prefix + name) for name in (DELETES, spec.change_col, spec.order_col)}


def _same_run(left: dict[str, Column], right: dict[str, Column], spec: ScdSpec) -> Column:
    """Two deletes, two upserts with equal stamps (a missing stamp equals nothing), or copies of one event."""
    stamp = spec.change_col
    equal = left[DELETES] & right[DELETES]
    equal = equal | (~left[DELETES] & ~right[DELETES] & (left[stamp] == right[stamp]))
    return F.coalesce(equal | (left[spec.order_col] == right[spec.order_col]), F.lit(False))


def _tail_columns(columns, spec: ScdSpec) -> list[str]:
    return [TAIL + name for name in (*spec.lineage_in(columns), ENDS_AT, SEEN)]


def _runs(events: DataFrame, group: list[str], spec: ScdSpec) -> DataFrame:
    """One row per run: the first event's image, and what the last event adds (lineage, end, sequence)."""
    arrival = [*spec.arrival_in(events.columns), TIE]
    ordered = Window.partitionBy(*group).orderBy(spec.order_col, *arrival)
    copies = Window.partitionBy(*group, spec.order_col).orderBy(*arrival)
    # Shuffled by the key up front; without this the copies window would add an exchange of its own.
    facts = events.repartition(*group).withColumn(TIE, _image_hash(events, spec)).withColumns(
        {name: F.first(name).over(copies) for name in (DELETES, spec.change_col, ENDS_AT)}
    )
    shape = _shape(spec)
    neighbours = {f"_before{name}": F.lag(column).over(ordered) for name, column in shape.items()}
    neighbours |= {f"_after{name}": F.lead(column).over(ordered) for name, column in shape.items()}
    marked = facts.withColumns(neighbours).withColumns(
        {
            "_starts": ~_same_run(_shape(spec, "_before"), shape, spec),
            "_stops": ~_same_run(shape, _shape(spec, "_after"), spec),
        }
    )
    ends = marked.where(F.col("_starts") | F.col("_stops")).drop(*neighbours)
    tail = {
        name: F.when(F.col("_stops"), F.col(name.removeprefix(TAIL))).otherwise(
            F.lead(name.removeprefix(TAIL)).over(ordered)
        )
        for name in _tail_columns(events.columns, spec)
    }
    return ends.withColumns(tail).where(F.col("_starts")).drop("_starts", "_stops", ENDS_AT, SEEN, TIE)


def _image_hash(events: DataFrame, spec: ScdSpec) -> Column:
    """Tells copies of one event apart that arrived alike: the same one counts however rows are dealt out."""

    def hashable(field) -> Column:
        kind = field.dataType.simpleString()
        return F.to_json(F.struct(field.name)) if "map<" in kind or "variant" in kind else F.col(field.name)

    return F.xxhash64(*(hashable(f) for f in events.schema.fields if f.name not in (*spec.keys, spec.order_col, CHUNK)))


def _as_next(spec: ScdSpec, tail: str = TAIL) -> dict[str, Column]:
    """What a run tells the run before it."""
    values = (F.lit(True), F.col(DELETES), F.col(spec.change_col), F.col(tail + ENDS_AT), F.col(tail + SEEN))
    return dict(zip(NEXT, values))


def _link(runs: DataFrame, group: list[str], spec: ScdSpec) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(spec.order_col)
    following = {name: F.lead(value).over(ordered) for name, value in _as_next(spec).items()}
    return runs.withColumns({HAS_PREVIOUS: F.lag(F.lit(True), 1, False).over(ordered), **following})


def _finish(linked: DataFrame, spec: ScdSpec) -> DataFrame:
    """Runs that are versions, with keys, bounds and flags. No shuffle."""
    stamp_type = linked.schema[spec.change_col].dataType
    tombstone = F.col(DELETES)
    last = F.col(HAS_NEXT).isNull()
    ended_by_delete = F.coalesce(F.col(NEXT_DELETES), F.lit(False))
    # With its successor's stamp missing, when a version ended is unknown.
    valid_to = (
        F.when(tombstone, F.col(TAIL + ENDS_AT))
        .when(last, sentinel(spec.end_of_time, stamp_type))
        .when(ended_by_delete, F.col(NEXT_ENDS_AT))
        .otherwise(just_before(F.col(NEXT_STAMP)))
    )
    valid_from = F.when(tombstone, sentinel(spec.begin_of_time, stamp_type)).otherwise(F.col(spec.change_col))
    lineage = spec.lineage_in(linked.columns)
    internal = {DELETES, HAS_PREVIOUS, *NEXT, *_tail_columns(linked.columns, spec)}
    base = [c for c in linked.columns if c not in internal]
    natural = F.col(spec.keys[0]) if len(spec.keys) == 1 else F.concat_ws("-", *spec.keys)
    kept = linked.where(~tombstone | ~F.col(HAS_PREVIOUS))
    bounded = kept.select(
        *(
            F.when(tombstone, F.col(c)).otherwise(F.col(TAIL + c)).alias(c) if c in lineage else F.col(c)
            for c in base
        ),
        valid_from.alias(VALID_FROM),
        valid_to.alias(VALID_TO),
        last.alias(IS_CURRENT),
        (tombstone | ended_by_delete).alias(IS_DELETED),
        primary_key(spec).alias(PRIMARY_KEY),
        natural.alias(NATURAL_KEY),
        F.greatest(F.col(TAIL + SEEN), F.when(ended_by_delete, F.col(NEXT_SEEN))).alias(LAST_SEEN),
    )
    return bounded.withColumn(VERSION_KEY, version_key(stamp_type))


def _hot_versions(events: DataFrame, keys: list[str], hot: HotKeys, spec: ScdSpec) -> DataFrame:
    """The same rule, chunk by chunk. Only a chunk's first run and its last two can depend on other chunks."""
    order = spec.order_col
    chunked = hot.chunked(_without_copies(hot.rows(events, keys), keys, spec), keys, order)
    group = [*keys, CHUNK]
    ordered = Window.partitionBy(*group).orderBy(order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = _link(_runs(chunked, group, spec), group, spec).withColumns(
        {
            "_edge": ~F.col(HAS_PREVIOUS) | F.lead(order, 2).over(ordered).isNull(),
            "_gap": F.lead(order, 3).over(ordered).isNotNull(),
            "_upserts": F.count(F.when(~F.col(DELETES), 1)).over(whole),
        }
    )
    edges = _edges(runs, keys, spec)
    tail = _tail_columns(runs.columns, spec)
    corrected = [*tail, *NEXT, HAS_PREVIOUS]
    fixes = edges.where("_starts").select(
        *keys, order, F.lit(True).alias("_fixed"), *(f"_real{name}" for name in corrected)
    )
    small = hot.small(fixes)
    # An edge without a correction continues a run of an earlier chunk.
    joined = runs.join(small, null_safe(runs, small, [*keys, order]), "left").where(
        ~runs["_edge"] | small["_fixed"].isNotNull()
    )
    base = [runs[c] for c in runs.columns if c not in (*corrected, "_edge", "_gap", "_upserts")]
    linked = joined.select(
        *base,
        *(
            F.when(runs["_edge"], small[f"_real{name}"]).otherwise(runs[name]).alias(name)
            for name in corrected
        ),
    )
    merged_upsert = ~F.col("_starts") & ~F.col(DELETES)
    tombstone = F.col("_starts") & F.col(DELETES) & ~F.col(f"_real{HAS_PREVIOUS}")
    sizes = edges.groupBy(*group).agg(
        (
            F.max("_upserts")
            - F.count(F.when(merged_upsert, 1))
            + F.count(F.when(tombstone, 1))
        ).alias("_rows")
    )
    local = local_ordinals(_finish(linked, spec), group, [order], RECORD_NUMBER, RECORD_COUNT)
    return add_offsets(local, hot.small(chunk_offsets(sizes, keys)), keys, RECORD_NUMBER, RECORD_COUNT)


def _without_copies(events: DataFrame, keys: list[str], spec: ScdSpec) -> DataFrame:
    """First copy of each event, with the last copy's sequence mark and, if an upsert, its lineage.

    A partial aggregate, so the copies of one event never pile up in one task.
    """
    arrival = spec.arrival_in(events.columns)
    lineage = spec.lineage_in(events.columns)
    others = [c for c in events.columns if c not in keys and c != spec.order_col]
    arrived = F.struct(*arrival, _image_hash(events, spec))
    first = events.groupBy(*keys, spec.order_col).agg(
        F.min_by(F.struct(*others), arrived).alias("_first"),
        F.max_by(F.struct(*lineage, SEEN), arrived).alias("_last"),
    )
    image = F.col("_first")

    def value(name: str) -> Column:
        if name == SEEN:
            return F.col("_last")[SEEN]
        if name in lineage:
            return F.when(image[DELETES], image[name]).otherwise(F.col("_last")[name])
        return image[name]

    return first.select(*keys, spec.order_col, *(value(c).alias(c) for c in others))


def _edges(runs: DataFrame, keys: list[str], spec: ScdSpec) -> DataFrame:
    """Edge runs joined up across chunks: at most three rows per chunk and key, stored.

    A run that continues over a boundary is owned by its first piece. ``_gap`` says that inner runs follow,
    whose neighbours are already known inside the chunk.
    """
    order = spec.order_col
    tail = _tail_columns(runs.columns, spec)
    edges = runs.where("_edge").select(
        *keys, CHUNK, order, spec.change_col, DELETES, *tail, *NEXT, HAS_PREVIOUS, "_gap", "_upserts"
    )
    along = Window.partitionBy(*keys).orderBy(order)
    shape = _shape(spec)
    before = {f"_before{name}": F.lag(column).over(along) for name, column in shape.items()}
    numbered = edges.withColumns(before).withColumn(
        "_starts", F.col(HAS_PREVIOUS) | ~_same_run(_shape(spec, "_before"), shape, spec)
    )
    numbered = numbered.withColumn("_run", F.sum(F.col("_starts").cast("int")).over(along)).drop(*before)
    in_run = Window.partitionBy(*keys, "_run").orderBy(order)
    to_end = in_run.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    joined_up = numbered.withColumn("_final", F.last(F.struct(*tail, "_gap", *NEXT)).over(to_end))
    final = F.col("_final")
    heads = joined_up.where("_starts").withColumns({f"_real{name}": final[name] for name in tail})
    linked = heads.withColumns(
        {
            f"_real{name}": F.when(final["_gap"], final[name]).otherwise(F.lead(value).over(along))
            for name, value in _as_next(spec, f"_real{TAIL}").items()
        }
        | {f"_real{HAS_PREVIOUS}": F.col("_run") > 1}
    )
    pieces = joined_up.where(~F.col("_starts"))
    return written(linked.unionByName(pieces, allowMissingColumns=True).drop("_final", *tail, *NEXT))
