"""Raw change files → the append-only bronze change log."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.connect import connect_fields
from tidemark.functions.naming import bronze_fqn, bronze_namespace, split_fqn, value_subject
from tidemark.functions.timestamps import convert_timestamps, with_load_date, with_transformed_at
from tidemark.operators.evolve import BRONZE, align, desired_columns, lossy, plan_evolution
from tidemark.operators.flatten import flatten_envelope, is_delete
from tidemark.plans.ledger import Ledger, now, schema_text
from tidemark.plans.store import BUCKET, LOG
from tidemark.sources.messages import BRONZE_WRITE, FLUSH_TOPIC, json_text
from tidemark.sources.raw import CORRUPT, inferred_envelope, raw_format, read_raw
from tidemark.sources.tables import BUFFER
from tidemark.spec import AFTER_PREFIX, BEFORE_PREFIX, RAW_FILE, ScdSpec

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class BronzeWrite:
    fqn: str
    rows: int
    corrupt: int
    lossy: int
    schema_id: str | None


class LoadedError(Exception):
    """The rows are in the table; something after that failed. Only the same load may be repeated: it replaces itself."""

    def __init__(self, write: BronzeWrite):
        super().__init__(f"{write.fqn} has the rows, but what belongs to them could not be recorded")
        self.write = write


def ingest_bronze(
    spark: SparkSession,
    store,
    paths: str | Iterable[str],
    source_fqn: str,
    ledger: Ledger,
    value_schema: str | None = None,
    schema: T.StructType | None = None,
    loaded_at: datetime | None = None,
    load: str | None = None,
    spec: ScdSpec = ScdSpec(),
) -> BronzeWrite:
    """Load any number of raw files of one source table in one pass.

    ``schema`` (see ``raw.envelope_schema``) spares the inference pass. Counts come from the write itself;
    only if it met damaged lines or values that fit no column type is there a second pass, for the dead letters.

    Rows go to partitions named by ``load`` and the day of ``loaded_at``. A load that is repeated with both the same replaces its rows,
    so that it never counts twice; without a name every call is a load of its own. The ledger knows of the
    load before the table has rows of it, and afterwards which raw files, buffers and key buckets they are of.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    load, loaded_at = load or uuid.uuid4().hex, loaded_at or now()
    target = bronze_fqn(source_fqn)
    if schema is None and raw_format(paths) == "json":
        schema = inferred_envelope(spark, paths)
    if schema is not None and "payload" not in schema.fieldNames():
        raise ValueError(f"no change envelope in {paths[0]} (and {len(paths) - 1} more files)")
    raw = read_raw(spark, paths, schema)
    raw = raw.select("*", F.col("_metadata.file_path").alias(RAW_FILE))
    damaged = F.col(CORRUPT).isNotNull() if CORRUPT in raw.columns else F.lit(False)
    seen = Observation()
    counted = raw.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(damaged.cast("bigint")), F.lit(0)).alias("corrupt")
    )
    flat = convert_timestamps(flatten_envelope(counted.where(~damaged), RAW_FILE))
    stamped = with_transformed_at(with_load_date(flat, F.lit(loaded_at)))

    desired = desired_columns(stamped.drop(RAW_FILE).schema, connect_fields(value_schema), BRONZE)
    table_schema = None
    if store.exists(target):
        plan = plan_evolution(target, store.schema(target), desired)
        store.evolve(target, plan)
        table_schema = plan.schema
    lost = lossy(stamped, desired, table_schema)
    losses = Observation()
    if lost is not None:
        stamped = stamped.observe(losses, F.coalesce(F.sum(lost.cast("bigint")), F.lit(0)).alias("rows"))
    ledger.begin_load(target, load, paths, loaded_at)
    store.create_append(target, align(stamped, desired, table_schema), load, _key_bucket(store, target, stamped, spec))

    rows, corrupt = seen.get["rows"] - seen.get["corrupt"], seen.get["corrupt"]
    lost_rows = losses.get["rows"] if lost is not None else 0
    try:
        ledger.finish_load(target, load, loaded_at, load_summary(store.read_log(target, loads=[load]), spec))
        return _recorded(ledger, store, target, source_fqn, raw, damaged, rows, corrupt, lost_rows, desired, table_schema)
    except Exception as error:
        raise LoadedError(BronzeWrite(target, rows, corrupt, lost_rows, None)) from error


def _key_bucket(store, target: str, rows: DataFrame, spec: ScdSpec) -> Column:
    """The bucket of each change's key, which stands in the image before a delete, else in the one after."""

    def key(name: str) -> Column:
        before, after = (F.col(f"`{p}{name}`").cast("string") if p + name in rows.columns else F.lit(None).cast("string") for p in (BEFORE_PREFIX, AFTER_PREFIX))
        return F.when(is_delete(spec), before).otherwise(after) if spec.op_col in rows.columns else after

    return store.bucket_of(target, [key(name) for name in spec.keys], LOG)


def load_summary(rows: DataFrame, spec: ScdSpec) -> DataFrame:
    """What a load holds of each raw file and buffer: its key buckets, rows and sequence range. One narrow pass."""
    order = F.col(spec.order_col).try_cast("bigint") if spec.order_col in rows.columns else F.lit(None).cast("bigint")
    buffer = F.col(BUFFER) if BUFFER in rows.columns else F.lit(None).cast("string")
    bucket = F.col(BUCKET) if BUCKET in rows.columns else F.lit(None).cast("int")
    named = F.col(RAW_FILE) if RAW_FILE in rows.columns else F.lit(None).cast("string")
    return rows.groupBy(named.alias("raw_file_path"), buffer.alias("extract_buffer_id")).agg(
        F.collect_set(bucket).alias("buckets"), F.count(F.lit(1)).alias("row_count"),
        F.min(order).alias("source_min_lsn"), F.max(order).alias("source_max_lsn"),
    )


def _recorded(ledger, store, target, source_fqn, raw, damaged, rows, corrupt, lost_rows, desired, table_schema) -> BronzeWrite:
    """Dead letters and schema version of rows that have been loaded."""
    if corrupt:
        why = F.when(F.col("payload").isNull(), "line is not a change envelope").otherwise(
            "a field of the line does not fit the schema"
        )
        ledger.reject(raw.where(damaged), CORRUPT, FLUSH_TOPIC, "CorruptRecord", why, source_fqn)
    if lost_rows:
        flat_again = with_transformed_at(with_load_date(convert_timestamps(flatten_envelope(raw.where(~damaged)))))
        unfit = flat_again.where(lossy(flat_again, desired, table_schema)).withColumn(
            "_payload", json_text(F.struct("*"))
        )
        why = F.lit("a value does not fit its column")
        ledger.reject(unfit, "_payload", FLUSH_TOPIC, "ValueLost", why, source_fqn)
    database, namespace, name = split_fqn(target)
    schema_id = ledger.register_schema(
        value_subject(database, namespace, name), schema_text(store.schema(target))
    )
    return BronzeWrite(target, rows, corrupt, lost_rows, schema_id)


def bronze_registration(flush: dict, write: BronzeWrite, rows: int, store_root: str, table_schema: str) -> dict:
    """Audit row of a bronze write from its file-flush record."""
    copied = (
        "raw_file_path", "raw_file_size", "extract_job_id", "extract_buffer_id", "extract_type",
        "extract_start_at", "extract_end_at", "source_instance_name", "source_database_name",
        "source_schema_name", "source_table_name", "source_min_lsn", "source_max_lsn",
    )
    schema_name = flush.get("source_schema_name")
    return {
        **{name: flush.get(name) for name in copied},
        "write_type": BRONZE_WRITE,
        "database_name": flush.get("source_database_name"),
        "namespace_name": bronze_namespace(schema_name) if schema_name else None,
        "table_name": flush.get("source_table_name"),
        "kafka_topic": FLUSH_TOPIC,
        "kafka_partition": flush.get("partition"),
        "kafka_offset": flush.get("offset"),
        "write_row_count": rows,
        "warehouse_path": store_root,
        "value_schema": table_schema,
        "value_schema_id": write.schema_id,
    }


def table_updated(flush: dict, write: BronzeWrite, store, catalog: str | None = None, loaded_on: date | None = None, rows: int | None = None) -> dict:
    """Notification that a bronze table has grown by one buffer: by how many rows, in the partition of which day."""
    passed_on = (
        "source_instance_name", "source_database_name", "source_schema_name", "source_table_name", "raw_file_path",
        "raw_file_size", "extract_job_id", "extract_buffer_id", "extract_type", "extract_start_at", "extract_end_at",
        "key_schema", "value_schema", "key_schema_id", "value_schema_id", "source_min_lsn", "source_max_lsn",
    )
    schema_name = flush.get("source_schema_name")
    return {
        **{name: flush.get(name) for name in passed_on},
        "write_type": BRONZE_WRITE,
        "table_fqn": write.fqn,
        "table_path": store.path(write.fqn),
        "format": getattr(store, "table_format", "parquet").upper(),
        "catalog_name": catalog,
        "database_name": flush.get("source_database_name"),
        "namespace_name": bronze_namespace(schema_name) if schema_name else None,
        "table_name": flush.get("source_table_name"),
        "warehouse_path": getattr(store, "root", None),
        "load_date": loaded_on,
        "write_row_count": rows,
    }
