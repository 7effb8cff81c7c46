"""Bronze buffers → silver type 2 and type 1."""

from __future__ import annotations

import hashlib
import logging
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.connect import connect_fields
from tidemark.functions.naming import (
    TYPE1_SUFFIX,
    TYPE2_SUFFIX,
    is_present,
    silver_fqn,
    silver_from_bronze,
    type1_table,
    type2_table,
    value_subject,
    split_fqn,
)
from tidemark.functions.timestamps import with_transformed_at
from tidemark.operators.evolve import SILVER, align, desired_columns, plan_evolution
from tidemark.operators.flatten import change_image, has_key
from tidemark.operators.incremental import LATE, extend_type2, key_state
from tidemark.operators.scratch import scratch_scope, written
from tidemark.operators.silver import ensure_layout, type1_of_complete
from tidemark.operators.versions import build_type2
from tidemark.plans.ledger import Ledger, now, schema_text
from tidemark.plans.store import HIDDEN
from tidemark.sources.messages import APPLIED, TYPE1_WRITE, TYPE2_WRITE, UPDATED_TOPIC, json_text
from tidemark.sources.tables import BUFFER, buffer_rows
from tidemark.spec import (
    GENERATION,
    IS_DELETED,
    LAST_SEEN,
    RECORD_COUNT,
    RECORD_NUMBER,
    TRANSFORMED_AT,
    TYPE2_COLUMNS,
    VERSION_KEY,
    ScdSpec,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SilverWrite:
    type2_fqn: str
    type1_fqn: str
    type2_rows: int
    type1_rows: int
    keyless: int
    rebuilt: bool


def transform_buffers(
    spark: SparkSession,
    store,
    bronze_table: str,
    buffers: str | Iterable[str] | None,
    spec: ScdSpec,
    ledger: Ledger,
    message: dict | None = None,
    loads: Iterable[tuple[str, date, int]] | None = None,
    messages: Iterable[dict] | None = None,
) -> SilverWrite | None:
    """Apply one or more extract buffers of a bronze table to its two silver tables.

    Keys are extended from their last versions; older bronze rows are read only for keys that got events out of order, in the
    partitions of their buckets and of the days that have rows of these. Running a buffer again changes nothing, and is found out
    from the ledger without reading the tables. Where bronze holds the buffers the ledger knows too; ``loads`` (buffer, load date, rows)
    say it for tables that were loaded elsewhere. Unless one of them names every buffer, and its rows are there,
    all partitions are searched. A buffer that is nowhere is an error. ``messages`` are the buffers' notifications, for the audit.
    """
    buffers = [b for b in ([buffers] if isinstance(buffers, str) else list(buffers or [])) if is_present(b)]
    if not buffers:
        log.warning("%s: no extract buffer named; nothing to do", bronze_table)
        return None
    messages = list(messages or [message or {}])
    with scratch_scope(spark):
        return _transform(store, bronze_table, list(dict.fromkeys(buffers)), spec, ledger, messages, loads)


def _places(known: list, announced: Iterable[tuple[str, date, int]] | None, buffers: list[str]) -> Iterator[tuple]:
    """Where to look for the buffers, best known first: rows expected of each, days, loads. Nothing expected: everywhere."""
    if {r.extract_buffer_id for r in known} >= set(buffers):
        expected: dict[str, int] = defaultdict(int)
        for r in known:
            expected[r.extract_buffer_id] += r.rows
        yield dict(expected), sorted({tuple(r.day) for r in known}), sorted({r.load for r in known})
    expected, days = {}, set()
    for buffer, day, rows in announced or ():
        expected[buffer] = max(rows, expected.get(buffer, 0))
        days.add((day.year, day.month, day.day))
    if expected.keys() >= set(buffers):
        yield expected, sorted(days), None
    yield {}, None, None


def _transform(store, bronze_table, buffers, spec, ledger, messages, announced) -> SilverWrite:
    type2, type1 = silver_fqn(bronze_table, TYPE2_SUFFIX), silver_fqn(bronze_table, TYPE1_SUFFIX)
    store.refresh()
    known = store.exists(type2)
    in_ledger = ledger.loads_of_buffers(bronze_table, type2, buffers)
    if known and {r.extract_buffer_id for r in in_ledger} == set(buffers) and all(r.applied for r in in_ledger):
        log.info("%s has %s already", type2, buffers)
        return SilverWrite(type2, type1, 0, 0, 0, False)
    bucket = store.bucket_of(type2, spec.keys)
    asked = {b: n for b, _, n in announced or ()}
    for expected, days, loads in _places(in_ledger, announced, buffers):
        changes = change_image(buffer_rows(store.read_log(bronze_table, days, loads).drop(*HIDDEN), buffers), spec)
        # One narrow pass; a row per buffer of the batch, a set with at most one number per bucket of the table.
        counts = changes.groupBy(BUFFER).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(F.when(~has_key(spec), 1)).alias("keyless"),
            F.collect_set(F.when(has_key(spec), bucket)).alias("buckets"),
        ).collect()
        found = {r[BUFFER]: r["rows"] for r in counts}
        if expected and all(found.get(b, 0) >= expected[b] for b in buffers):
            break
    absent = [b for b in buffers if b not in found and asked.get(b) != 0]
    if absent or not found:
        raise ValueError(f"no bronze rows for buffers {absent or buffers} in {bronze_table}")
    concerned = sorted({b for r in counts for b in r["buckets"]})
    keyless = sum(r["keyless"] for r in counts)
    if keyless:
        lost = changes.where(~has_key(spec)).withColumn("_payload", json_text(F.struct("*")))
        why = F.lit("change without key or sequence number")
        ledger.reject(lost, "_payload", UPDATED_TOPIC, "KeylessChange", why, bronze_table)

    declared = connect_fields(messages[-1].get("value_schema"))
    if known:
        upgrade_layout(store, type2, spec)
    base_schema = _evolved(store, type2, changes, declared) if known else None

    def prepared(rows: DataFrame) -> DataFrame:
        keyed = rows.where(has_key(spec))
        return align(keyed, desired_columns(keyed.schema, declared, SILVER), base_schema)

    own = set(changes.columns)
    changes = prepared(changes)
    tips = store.tips(type2, concerned) if known else None
    # Stored: it is used after the tables it is computed from have been replaced.
    state = written(key_state(changes, tips, spec))
    late = [r[0] for r in state.where(LATE).select(store.bucket_of(bronze_table, spec.keys)).distinct().collect()] if known else []
    everything = None
    if late:
        bronze = store.read_log(bronze_table, ledger.days_of_buckets(bronze_table, late), None, late).drop(*HIDDEN)
        everything = prepared(change_image(bronze, spec))
    delta = extend_type2(state, changes, tips, everything, spec, _generation())
    if late:
        delta = _with_silver_only(delta, store.read(type2, concerned), own)
    seen = Observation()
    # Stored once: it feeds both tables, and lost executors do not make it be computed again.
    delta = written(_counted(with_transformed_at(delta), seen))
    if known:
        _evolve_to(store, type2, delta.drop(GENERATION))
    load = _load_name(in_ledger, buffers)
    started = now()
    store.write_history(type2, delta, spec.keys, load, concerned)
    between = now()
    latest = type1_of_complete(delta).drop(GENERATION)
    if store.exists(type1):
        _evolve_to(store, type1, latest)
    store.upsert(type1, latest, spec.keys, concerned)
    finished = now()
    if in_ledger:
        ledger.mark_loads(APPLIED, type2, [(r.load, r.extract_buffer_id) for r in in_ledger])
    rows = _rows_of_buffers(delta, buffers, seen)
    _register(store, ledger, messages, type2, TYPE2_WRITE, rows[0], started, between, buffers)
    _register(store, ledger, messages, type1, TYPE1_WRITE, rows[1], between, finished, buffers)
    return SilverWrite(type2, type1, seen.get["type2"], seen.get["type1"], keyless, bool(late))


def _generation() -> int:
    """Rises from one write of a table to the next, as a table has one writer."""
    return int(now().timestamp() * 1_000_000)


def _load_name(in_ledger: list, buffers: list[str]) -> str:
    """The same for the same buffers of the same bronze loads: a write that is repeated replaces its closed versions."""
    parts = sorted(f"{r.load}:{r.extract_buffer_id}" for r in in_ledger) or sorted(buffers)
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:32]


def _counted(delta: DataFrame, seen: Observation) -> DataFrame:
    last = F.col(RECORD_NUMBER) == F.col(RECORD_COUNT)
    return delta.observe(seen, F.count(F.lit(1)).alias("type2"), F.count(F.when(last, 1)).alias("type1"))


def _rows_of_buffers(delta: DataFrame, buffers: list[str], seen: Observation) -> tuple[dict[str, int], dict[str, int]]:
    """Rows written for each buffer, to type 2 and to type 1: those whose last change it brought; of a single buffer, all."""
    if len(buffers) == 1:
        return {buffers[0]: seen.get["type2"]}, {buffers[0]: seen.get["type1"]}
    last = F.count(F.when(F.col(RECORD_NUMBER) == F.col(RECORD_COUNT), 1))
    rows = delta.where(F.col(BUFFER).isin(*buffers)).groupBy(BUFFER).agg(F.count(F.lit(1)).alias("all"), last.alias("last")).collect()
    return {r[BUFFER]: r["all"] for r in rows}, {r[BUFFER]: r["last"] for r in rows}


def rebuild_silver(
    spark: SparkSession, store, bronze_table: str, spec: ScdSpec, message: dict | None = None
) -> SilverWrite:
    """Both silver tables anew from the whole change log: the definition of what they must hold."""
    with scratch_scope(spark):
        return _rebuild(store, bronze_table, spec, message or {})


def _rebuild(store, bronze_table, spec, message) -> SilverWrite:
    type2, type1 = silver_fqn(bronze_table, TYPE2_SUFFIX), silver_fqn(bronze_table, TYPE1_SUFFIX)
    store.refresh()
    declared = connect_fields(message.get("value_schema"))
    changes = change_image(store.read(bronze_table), spec).where(has_key(spec))
    changes = align(changes, desired_columns(changes.schema, declared, SILVER))
    seen, generation = Observation(), _generation()
    history = with_transformed_at(build_type2(changes, spec)).withColumn(GENERATION, F.lit(generation))
    history = written(_counted(history, seen))
    if store.exists(type2):
        _evolve_to(store, type2, history.drop(GENERATION))
    store.write_history(type2, history, spec.keys, f"rebuilt-{generation}")
    latest = type1_of_complete(history).drop(GENERATION)
    if store.exists(type1):
        _evolve_to(store, type1, latest)
    store.upsert(type1, latest, spec.keys)
    return SilverWrite(type2, type1, seen.get["type2"], seen.get["type1"], 0, True)


def upgrade_layout(store, fqn: str, spec: ScdSpec) -> None:
    """Give a type-2 table from before the deleted flag, version key or last-seen mark those columns.

    A single rewrite of the table, the first time it is met; afterwards only its schema is looked at.
    """
    if {IS_DELETED, VERSION_KEY, LAST_SEEN} <= set(store.schema(fqn).fieldNames()):
        return
    generation = _generation()
    full = written(ensure_layout(store.read(fqn), spec).withColumn(GENERATION, F.lit(generation)))
    _evolve_to(store, fqn, full.drop(GENERATION))
    store.write_history(fqn, full, spec.keys, f"upgraded-{generation}")


def _evolve_to(store, fqn: str, rows: DataFrame) -> None:
    """Let a table take all columns of the rows about to be written; also brings older layouts up to date."""
    store.evolve(fqn, plan_evolution(fqn, store.schema(fqn), desired_columns(rows.schema, {}, SILVER)))


def _evolved(store, fqn: str, changes: DataFrame, declared: dict):
    """Bring the silver table's schema up to date; returns its columns besides the derived ones."""
    desired = desired_columns(changes.schema, declared, SILVER)
    plan = plan_evolution(fqn, store.schema(fqn), desired)
    store.evolve(fqn, plan)
    fields = [f for f in plan.schema.fields if f.name not in TYPE2_COLUMNS]
    return type(plan.schema)(fields)


def _with_silver_only(delta: DataFrame, silver: DataFrame, own: set[str]) -> DataFrame:
    """Rebuilt versions keep what silver alone holds: columns that no change brings."""
    extra = [c for c in silver.columns if c not in own and c not in (*TYPE2_COLUMNS, TRANSFORMED_AT)]
    if not extra:
        return delta
    kept = silver.select(VERSION_KEY, *(F.col(c).alias(f"_kept_{c}") for c in extra))
    joined = delta.join(kept, VERSION_KEY, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"_kept_{c}")) for c in extra}).select(*delta.columns)


def _register(store, ledger, messages, fqn, write_type, rows, started, finished, buffers) -> None:
    """An audit row for each buffer, with its own notification's file, times and range."""
    database, namespace, table = split_fqn(fqn)
    schema_json = schema_text(store.schema(fqn))
    schema_id = ledger.register_schema(value_subject(database, namespace, table), schema_json)
    copied = (
        "source_instance_name", "source_database_name", "source_schema_name", "source_table_name", "raw_file_path",
        "raw_file_size", "extract_job_id", "extract_type", "extract_start_at", "extract_end_at", "source_min_lsn",
        "source_max_lsn", "catalog_name",
    )
    naming = type2_table if write_type == TYPE2_WRITE else type1_table
    by_buffer = {m.get("extract_buffer_id"): m for m in messages}
    writes = []
    for buffer in buffers:
        message = by_buffer.get(buffer) or messages[-1]
        source_table = message.get("source_table_name") or message.get("table_name")
        writes.append(
            {
                **{name: message.get(name) for name in copied},
                "write_type": write_type,
                "database_name": message.get("database_name"),
                "namespace_name": silver_from_bronze(message.get("namespace_name")),
                "table_name": naming(source_table) if source_table else None,
                "kafka_topic": UPDATED_TOPIC,
                "kafka_partition": message.get("partition"),
                "kafka_offset": message.get("offset"),
                "write_row_count": rows.get(buffer, 0),
                "merge_row_count": rows.get(buffer, 0),
                "extract_buffer_id": buffer,
                "merge_start_at": started,
                "merge_end_at": finished,
                "warehouse_path": getattr(store, "root", None),
                "value_schema": schema_json,
                "value_schema_id": schema_id,
            }
        )
    ledger.register_writes(writes)
