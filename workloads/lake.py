"""Whole jobs: raw files → bronze → silver tables in the shared folder, as batches and as streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.connect import connect_fields
from tidemark.operators.evolve import SILVER, desired_columns, plan_evolution
from tidemark.operators.scratch import scratch_path
from tidemark.plans.bronze import ingest_bronze
from tidemark.plans.ledger import Ledger
from tidemark.plans.silver import transform_buffers
from tidemark.plans.store import FolderStore
from tidemark.sources.raw import envelope_schema
from tidemark.spec import ScdSpec
from tidemark.streaming.jobs import start_bronze, start_silver
from workloads.history import EVENT_CHANGES, HISTORY, TYPE1, VERSIONS, WITH_DELETES
from workloads.records import FLAT, ROW, event_envelopes
from workloads.registry import query, shown, table

SPEC = ScdSpec()
SOURCE = "shop.public.events"
BRONZE = "shop.public_bronze.events"
TYPE2 = "shop.public_silver.events_type2"
TYPE1_TABLE = "shop.public_silver.events_type1"
BUFFER = "extract.extract_buffer_id"


def _lake(spark: SparkSession, sf_dir: str) -> tuple[FolderStore, Ledger, str]:
    """A new lake, and the events as raw change files with a folder per day."""
    root = scratch_path(spark)
    event_envelopes(spark, sf_dir).withColumn("day", F.col(BUFFER)).write.partitionBy("day").json(f"{root}/raw")
    return FolderStore(spark, f"{root}/lake", buckets=8), Ledger(spark, f"{root}/ledger"), root


def _batches(spark: SparkSession, sf_dir: str) -> FolderStore:
    """Three loads, each applied to silver on its own; the first is applied twice."""
    store, ledger, root = _lake(spark, sf_dir)
    days = [r[0] for r in event_envelopes(spark, sf_dir).select(F.col(BUFFER).alias("day")).distinct().orderBy("day").collect()]
    third = -(-len(days) // 3)
    parts = [days[:third], days[third : 2 * third], days[2 * third :]]
    for buffers in filter(None, parts):
        paths = [f"{root}/raw/day={day}/*.json" for day in buffers]
        ingest_bronze(spark, store, paths, SOURCE, ledger, schema=envelope_schema(ROW))
        transform_buffers(spark, store, BRONZE, buffers, SPEC, ledger)
    transform_buffers(spark, store, BRONZE, parts[0], SPEC, ledger)
    return store


@query(WITH_DELETES)
def lake_type2_table(spark, sf_dir):
    return shown(_batches(spark, sf_dir).read(TYPE2), *HISTORY)


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS}
SELECT {", ".join(TYPE1)} FROM t2 WHERE _is_current OR _is_deleted
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _source_lsn DESC) = 1
""")
def streamed_type1_table(spark, sf_dir):
    """A notification per day's raw files, through the bronze and the silver stream."""
    store, ledger, root = _lake(spark, sf_dir)
    known = {
        "raw_file_path": F.concat(F.lit(f"{root}/raw/day="), F.col("day"), F.lit("/*.json")),
        "table_name": F.lit(SOURCE),
        "extract_buffer_id": F.col("day"),
        "source_min_lsn": F.col("lo"),
        "source_max_lsn": F.col("hi"),
    }
    days = event_envelopes(spark, sf_dir).groupBy(F.col(BUFFER).alias("day")).agg(
        F.min("payload.source.lsn").alias("lo"), F.max("payload.source.lsn").alias("hi")
    )
    days.select(*(c.alias(n) for n, c in known.items())).coalesce(1).write.json(f"{root}/in")
    _streamed(spark, store, ledger, root)
    return store.read(TYPE1_TABLE).select(*TYPE1)


def _streamed(spark, store, ledger, root) -> None:
    start_bronze(spark, store, ledger, f"{root}/in", f"{root}/out", f"{root}/cp1", SPEC).awaitTermination()
    start_silver(spark, store, ledger, f"{root}/out", f"{root}/cp2", SPEC).awaitTermination()


def _two_files_a_day(spark: SparkSession, sf_dir: str) -> tuple[FolderStore, Ledger, str]:
    """Raw files in two folders for each day, and a notification with its whole identity for each of them."""
    root = scratch_path(spark)
    half = F.col("payload.source.lsn") % 2
    event_envelopes(spark, sf_dir).withColumns({"day": F.col(BUFFER), "half": half}).write.partitionBy("day", "half").json(f"{root}/raw")
    folders = event_envelopes(spark, sf_dir).select(F.col(BUFFER).alias("day"), half.cast("string").alias("half")).distinct()
    known = {
        "raw_file_path": F.concat(F.lit(f"{root}/raw/day="), F.col("day"), F.lit("/half="), F.col("half"), F.lit("/*.json")),
        "table_name": F.lit(SOURCE),
        "extract_buffer_id": F.col("day"),
        "extract_start_at": F.concat(F.col("day"), F.lit("T00:00:00Z")),
        "extract_end_at": F.concat(F.col("day"), F.lit("T23:59:59Z")),
        **{f"source_{part}_name": F.lit(name) for part, name in (("instance", "main"), ("database", "shop"), ("schema", "public"), ("table", "events"))},
    }
    folders.select(*(c.alias(n) for n, c in known.items())).coalesce(1).write.json(f"{root}/in")
    return FolderStore(spark, f"{root}/lake", buckets=8), Ledger(spark, f"{root}/ledger"), root


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS}
SELECT 'bronze' AS write_type, strftime(ts, 'day=%Y-%m-%d') || '/half=' || event_id % 2 AS folder, strftime(ts, '%Y-%m-%d') AS extract_buffer_id,
       count(*) AS write_row_count, min(event_id) AS source_min_lsn, max(event_id) AS source_max_lsn, 'public_bronze' AS namespace_name,
       'events' AS table_name FROM events GROUP BY 2, 3
UNION ALL SELECT 'silver_type_2', NULL, _extract_buffer_id, count(*), NULL, NULL, 'public_silver', 'events_type2' FROM t2 GROUP BY 3
UNION ALL SELECT 'silver_type_1', NULL, _extract_buffer_id, sum(CASE WHEN _record_number = _record_count THEN 1 ELSE 0 END), NULL, NULL,
       'public_silver', 'events_type1' FROM t2 GROUP BY 3
""")
def writes_registered(spark, sf_dir):
    """Audit rows of a whole run: of bronze for each notified file, two of each buffer, of silver for each buffer."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    _streamed(spark, store, ledger, root)
    bronze = F.col("write_type") == "bronze"
    folder = F.regexp_extract("raw_file_path", "/raw/(.*)/[*].json$", 1)
    low, high = (F.when(bronze, F.col(f"source_{end}_lsn")).alias(f"source_{end}_lsn") for end in ("min", "max"))
    return ledger.read("table_writes").select(
        "write_type", F.when(bronze, folder).alias("folder"), "extract_buffer_id", "write_row_count", low, high, "namespace_name", "table_name"
    )


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS}
SELECT 'table_writer.process_record.records' AS operation, 'shop.public.events' AS table_identity, 'success' AS outcome,
       count(*) AS rows, true AS timed FROM events
UNION ALL SELECT 'type2_dimension.process_record.records', 'shop.public_bronze.events', 'success', count(*), true FROM t2
""")
def run_metrics_recorded(spark, sf_dir):
    """What a whole run says of itself: rows and outcome of each operation."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    _streamed(spark, store, ledger, root)
    metrics = ledger.read("run_metrics").groupBy("operation", "table_identity", "outcome")
    timed = F.min(F.col("started_at") <= F.col("ended_at"))
    return metrics.agg(F.sum("rows").alias("rows"), timed.alias("timed"))


class _Unfinished(Ledger):
    """A ledger that is out of reach once the rows of a load are in the table."""

    def finish_load(self, *_):
        raise OSError("the ledger is out of reach")


def _no_sink(_: DataFrame) -> None:
    raise OSError("no sink")


STAMP_TEXT = "CAST(ts AS VARCHAR)"


BRONZE_ROWS = f"""
SELECT {", ".join(f"CASE WHEN event_type <> 'signup' THEN {v} END AS before_{n}" for n, v in (("id", "user_id"), ("name", "event_type"), ("value", "value"), ("updated_at", STAMP_TEXT)))},
       {", ".join(f"CASE WHEN event_type <> 'error' THEN {v} END AS after_{n}" for n, v in (("id", "user_id"), ("name", "event_type"), ("value", "value"), ("updated_at", STAMP_TEXT)))},
       'shop' AS _source_db, event_id AS _source_lsn,
       CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS _op,
       epoch_us(ts) // 1000 AS _ts_ms, 'job-1' AS _extract_job_id, strftime(ts, '%Y-%m-%d') AS _extract_buffer_id,
       'stream' AS _extract_type, {STAMP_TEXT} AS _extracted_at
FROM events
"""


@query(BRONZE_ROWS)
def streamed_restart(spark, sf_dir):
    """The bronze stream stops after its append, again before its announcement, is run to its end, and is sent every record once more."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    for failing, outbox in ((_Unfinished(spark, f"{root}/ledger"), f"{root}/out"), (ledger, _no_sink)):
        try:
            start_bronze(spark, store, failing, f"{root}/in", outbox, f"{root}/cp1", SPEC).awaitTermination()
        except StreamingQueryException:
            pass
    start_bronze(spark, store, ledger, f"{root}/in", f"{root}/out", f"{root}/cp1", SPEC).awaitTermination()
    spark.read.text(f"{root}/in").write.mode("append").text(f"{root}/in")
    start_bronze(spark, store, ledger, f"{root}/in", f"{root}/out", f"{root}/cp1", SPEC).awaitTermination()
    return shown(store.read(BRONZE), *FLAT)


@query(BRONZE_ROWS)
def streamed_absent_files(spark, sf_dir):
    """Every file is announced, among records without a value, before half of them are there; those are loaded when they have come."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    moved = F.regexp_replace("raw_file_path", "/raw/(.*)half=1/", "/late/$1half=1/")
    spark.read.json(f"{root}/in").withColumn("raw_file_path", moved).coalesce(1).write.json(f"{root}/in2")
    spark.createDataFrame([("",), ("  ",)], "value string").coalesce(1).write.mode("append").text(f"{root}/in2")
    for late in (False, True):
        if late:
            raw = event_envelopes(spark, sf_dir).withColumns({"day": F.col(BUFFER), "half": F.col("payload.source.lsn") % 2}).where("half = 1")
            raw.write.partitionBy("day", "half").json(f"{root}/late")
        start_bronze(spark, store, ledger, f"{root}/in2", f"{root}/out", f"{root}/cp1", SPEC, wait=3600).awaitTermination()
    return shown(store.read(BRONZE), *FLAT)


@query(WITH_DELETES)
def silver_mixed_load_dates(spark, sf_dir):
    """Buffers whose rows came in three loads on three days, applied at once: bronze is read where the ledger says they are."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    days = [r[0] for r in event_envelopes(spark, sf_dir).select(F.col(BUFFER).alias("day")).distinct().orderBy("day").collect()]
    middle = len(days) // 2
    loads = [("half=0", days[middle:]), ("half=1", days), ("half=0", days[:middle])]
    for number, (half, part) in enumerate(loads):
        paths = [f"{root}/raw/day={day}/{half}/*.json" for day in part]
        if paths:
            ingest_bronze(spark, store, paths, SOURCE, ledger, schema=envelope_schema(ROW), loaded_at=datetime(2026, 5, 30 + number // 2, 1 + number))
    transform_buffers(spark, store, BRONZE, days, SPEC, ledger)
    return shown(store.read(TYPE2), *HISTORY)


@query("""
SELECT 'iceberg.shop.public_bronze.events-value' AS subject, v AS version, n AS fields, 'spark-table-schema' AS title,
       (SELECT count(*) FROM events) AS table_rows FROM (VALUES (1, 33), (2, 35)) t(v, n)
""")
def schemas_registered(spark, sf_dir):
    """Two loads, the second with a column more: two versions of the table's schema."""
    store, ledger, root = _two_files_a_day(spark, sf_dir)
    for half, row in (("0", T.StructType([f for f in ROW.fields if f.name != "value"])), ("1", ROW)):
        ingest_bronze(spark, store, f"{root}/raw/day=*/half={half}/*.json", SOURCE, ledger, schema=envelope_schema(row))
    wrapped = F.col("wrapped_json")
    fields = F.size(F.from_json(F.get_json_object(wrapped, "$.x-spark-schema.fields"), "array<string>"))
    return ledger.read("table_schemas").select(
        "subject", "version", fields.alias("fields"), F.get_json_object(wrapped, "$.title").alias("title"), F.lit(store.read(BRONZE).count()).alias("table_rows")
    )


STATUS = (
    '{"fields":[{"field":"o_orderkey","type":"int64"},{"field":"status","type":"string","default":"it\'s open"},'
    '{"field":"level","type":"int32","default":7},{"field":"broken","type":"int32","default":"x"}]}'
)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'it''s open' ELSE o_orderstatus END AS status,
       CAST(CASE WHEN o_orderstatus = 'P' THEN 7 ELSE o_custkey + 1 END AS INTEGER) AS level, CAST(NULL AS INTEGER) AS broken FROM orders
""")
def declared_defaults(spark, sf_dir):
    """Columns that were declared after rows had been written: these read as the default; one that does not fit its type is null."""
    store, fqn = FolderStore(spark, f"{scratch_path(spark)}/lake", buckets=8), "shop.public_silver.orders_type1"
    orders, key = table(spark, sf_dir, "orders"), ["o_orderkey"]
    pending = F.col("o_orderstatus") == "P"
    store.upsert(fqn, orders.where(pending).select("o_orderkey"), key)
    rest = orders.where(~pending).select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), (F.col("o_custkey") + 1).cast("int").alias("level"), F.lit(None).cast("int").alias("broken")
    )
    store.evolve(fqn, plan_evolution(fqn, store.schema(fqn), desired_columns(rest.schema, connect_fields(STATUS), SILVER)))
    store.upsert(fqn, rest, key)
    return store.read(fqn)


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS priority, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS urgency FROM orders
""")
def renamed_column(spark, sf_dir):
    """A column renamed upstream: the table keeps the old one for older rows and gets the new one beside it."""
    store, fqn = FolderStore(spark, f"{scratch_path(spark)}/lake", buckets=8), "shop.public_silver.orders_type1"
    orders = table(spark, sf_dir, "orders")
    for name, part in (("priority", F.col("o_orderstatus") == "P"), ("urgency", F.col("o_orderstatus") != "P")):
        rows = orders.where(part).select("o_orderkey", F.col("o_orderpriority").alias(name))
        if store.exists(fqn):
            store.evolve(fqn, plan_evolution(fqn, store.schema(fqn), desired_columns(rows.schema, {}, SILVER)))
        store.upsert(fqn, rows, ["o_orderkey"])
    return store.read(fqn)


@query("""
SELECT 'SchemaIncompatibleError' AS error, 'shop.public_bronze.events.after_value: cannot change double to string' AS why,
       'shop.public.events' AS table_identity, day AS extract_buffer_id, (SELECT count(*) FROM events) AS table_rows
FROM (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events)
""")
def refused_changes(spark, sf_dir):
    """Files in which a number has become text are refused, each as a dead letter; the table stays as it was."""
    store, ledger, root = _lake(spark, sf_dir)
    ingest_bronze(spark, store, f"{root}/raw/day=*/*.json", SOURCE, ledger, schema=envelope_schema(ROW))
    text = T.StructType([T.StructField(f.name, T.StringType() if f.name == "value" else f.dataType) for f in ROW.fields])
    days = [r[0] for r in event_envelopes(spark, sf_dir).select(F.col(BUFFER).alias("day")).distinct().collect()]
    for day in days:
        try:
            ingest_bronze(spark, store, f"{root}/raw/day={day}/*.json", SOURCE, ledger, schema=envelope_schema(text))
        except Exception as error:
            ledger.failed(error, "cdc-file-write", {"extract_buffer_id": day}, SOURCE)
    letters = ledger.read("dead_letters")
    return letters.select(
        F.element_at(F.split("exception_class", "[.]"), -1).alias("error"), F.col("exception_message").alias("why"), "table_identity", "extract_buffer_id",
        F.lit(store.read(BRONZE).count()).alias("table_rows"),
    )
