"""Audit tables: loads, write registrations, schema versions, dead letters, run metrics."""

from __future__ import annotations

import json
import logging
import traceback
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import UNKNOWN, is_present
from tidemark.sources.messages import (
    ABANDONED,
    ANNOUNCED,
    APPLIED,
    BEGUN,
    DEAD_LETTER,
    LOADED,
    RUN_METRIC,
    TABLE_LOAD,
    TABLE_SCHEMA,
    TABLE_WRITE,
    WAITING_FILE,
    to_messages,
)

log = logging.getLogger(__name__)

TABLES = {
    "table_writes": TABLE_WRITE,
    "table_schemas": TABLE_SCHEMA,
    "dead_letters": DEAD_LETTER,
    "run_metrics": RUN_METRIC,
    "table_loads": TABLE_LOAD,
    "waiting_files": WAITING_FILE,
}

# The JSON-Schema object a table schema is wrapped in.
SCHEMA_WRAPPER = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "type": "object",
    "title": "spark-table-schema",
    "additionalProperties": True,
}
SPARK_SCHEMA = "x-spark-schema"


def now() -> datetime:
    return datetime.now(timezone.utc)


def wrap_schema(schema_json: str) -> str:
    return json.dumps({**SCHEMA_WRAPPER, SPARK_SCHEMA: json.loads(schema_json)}, separators=(",", ":"))


class Ledger:
    """Append-only tables below one folder. Audit rows are best effort; loads and dead letters are not."""

    def __init__(self, spark: SparkSession, root: str, letters: Callable[[DataFrame], None] | None = None):
        """``letters`` also gets dead letters, as rows of ``key`` and ``value``: a topic, for instance."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.letters = letters
        self._schemas: dict[str, tuple[str, str]] = {}

    def read(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not location.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(location):
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(path)

    def append(self, name: str, rows: DataFrame) -> None:
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].fields]
        rows = rows.select(*columns)
        rows.write.mode("append").parquet(f"{self.root}/{name}")
        if name == "dead_letters" and self.letters is not None:
            self.letters(to_messages(rows, "table_identity"))

    def record(self, name: str, rows: list[dict]) -> None:
        schema = TABLES[name]
        values = [tuple(row.get(f.name) for f in schema.fields) for row in rows]
        if values:
            self.append(name, self.spark.createDataFrame(values, schema).coalesce(1))

    # Loads: what a log holds of which buffer, in which partitions, and how far each load has come

    def begin_load(self, table: str, load: str, paths: list[str], loaded_at: datetime) -> None:
        """Before any row of the load is in the table: what is repeated later can go where this goes."""
        shared = {"table_fqn": table, "load": load, "state": BEGUN, "loaded_at": loaded_at, "recorded_at": now()}
        self.record("table_loads", [{**shared, "raw_file_path": path} for path in paths])

    def finish_load(self, table: str, load: str, loaded_at: datetime, rows: DataFrame) -> None:
        """``rows``: for each raw file and buffer its key buckets, count and range. One more row says that the load is whole."""
        shared = {"table_fqn": F.lit(table), "load": F.lit(load), "state": F.lit(LOADED), "loaded_at": F.lit(loaded_at), "recorded_at": F.lit(now())}
        whole = self.spark.range(1).select(F.lit(None).cast("string").alias("raw_file_path"))
        self.append("table_loads", rows.unionByName(whole, allowMissingColumns=True).withColumns(shared).coalesce(1))

    def mark_loads(self, state: str, table: str, marks: list[tuple[str, str | None]]) -> None:
        """Loads (and buffers of them) that have been announced or given up, or that silver table ``table`` holds."""
        self.record("table_loads", [{"table_fqn": table, "load": load, "extract_buffer_id": buffer, "state": state, "recorded_at": now()} for load, buffer in marks])

    def loads_of_files(self, paths: list[str]) -> dict[str, dict]:
        """For each notified file that a load has begun with: the load that came furthest, its steps and its raw files. Loads that
        were given up (none of their rows are in the table) do not count, unless they have begun again.

        A row for each raw file and buffer of these loads reaches the driver, as notifications do."""
        steps = self.read("table_loads").where(F.col("state").isin(BEGUN, LOADED, ANNOUNCED, ABANDONED))
        begun = steps.where((F.col("state") == BEGUN) & F.col("raw_file_path").isin(*paths)).select("load").distinct()
        loads: dict[str, dict] = {}
        for row in steps.join(begun, "load", "left_semi").orderBy("recorded_at").collect():
            known = loads.setdefault(row.load, {"load": row.load, "table_fqn": row.table_fqn, "loaded_at": row.loaded_at, "states": set(), "paths": [], "files": {}})
            if row.state == ABANDONED:
                known["states"].clear()
                continue
            known["states"].add(row.state)
            if row.state == BEGUN and row.raw_file_path not in known["paths"]:
                known["paths"].append(row.raw_file_path)
            elif row.state == LOADED and row.raw_file_path is not None:
                known["files"][row.raw_file_path, row.extract_buffer_id] = row  # a repeated load says the same again
        found: dict[str, dict] = {}
        for known in sorted((k for k in loads.values() if k["states"]), key=lambda k: len(k["states"])):
            found |= {path: known for path in known["paths"] if path in paths}
        return found

    def loads_of_buffers(self, log: str, silver: str, buffers: list[str]) -> list:
        """``load, extract_buffer_id, day, rows, applied`` of every load of these buffers: where a log holds them, and whether silver does."""
        rows = self.read("table_loads").where(F.col("extract_buffer_id").isin(*buffers))
        loaded, applied = (F.col("table_fqn") == log) & (F.col("state") == LOADED), (F.col("table_fqn") == silver) & (F.col("state") == APPLIED)
        # A load that was repeated is recorded twice; its latest record counts.
        files = rows.where(loaded).groupBy("load", "extract_buffer_id", "raw_file_path").agg(
            F.max_by("row_count", "recorded_at").alias("rows"), F.max_by("loaded_at", "recorded_at").alias("at")
        )
        places = files.groupBy("load", "extract_buffer_id").agg(F.sum("rows").alias("rows"), F.max("at").alias("at"))
        held = rows.where(applied).select("load", "extract_buffer_id", F.lit(True).alias("applied")).distinct()
        day = F.struct(*(f(F.col("at")) for f in (F.year, F.month, F.dayofmonth))).alias("day")
        joined = places.join(held, ["load", "extract_buffer_id"], "left")
        return joined.select("load", "extract_buffer_id", day, "rows", F.coalesce("applied", F.lit(False)).alias("applied")).collect()

    def days_of_buckets(self, log: str, buckets: list[int]) -> list[tuple]:
        """Load dates on which the log got rows of these key buckets. A load that has begun and not ended may have got any."""
        rows = self.read("table_loads").where((F.col("table_fqn") == log) & F.col("state").isin(BEGUN, LOADED))
        hit = F.arrays_overlap("buckets", F.array(*(F.lit(b) for b in buckets))) if buckets else F.lit(False)
        loads = rows.groupBy("load").agg(
            F.max("loaded_at").alias("at"), F.bool_or(F.coalesce(hit, F.lit(False))).alias("hit"), F.bool_or(F.col("state") == LOADED).alias("whole")
        )
        days = loads.where(F.col("hit") | ~F.col("whole")).select(F.year("at"), F.month("at"), F.dayofmonth("at")).distinct()
        return [tuple(row) for row in days.collect()]

    # Files that were announced before they were there

    def waiting_files(self) -> dict[str, tuple[str, datetime]]:
        """Notified files that are still waited for: the notification's text, and since when."""
        rows = self.read("waiting_files").groupBy("raw_file_path")
        last = rows.agg(F.max_by(F.struct("message", "first_seen", "waiting"), "recorded_at").alias("last"))
        return {r.raw_file_path: (r.last.message, r.last.first_seen) for r in last.where("last.waiting = 1").collect()}

    def wait_for(self, files: list[tuple[str, str, datetime, bool]]) -> None:
        """Notified files (path, notification, first seen) that are waited for from now on, or no longer."""
        names = ("raw_file_path", "message", "first_seen", "waiting")
        self.record("waiting_files", [dict(zip(names, (*f[:3], int(f[3]))), recorded_at=now()) for f in files])

    # Write registration

    def register_writes(self, writes: list[dict]) -> int:
        """Register complete writes; what lacks its identity or extract times is skipped. Never fails a write."""
        complete = [w for w in writes if write_complete(w)]
        if len(complete) < len(writes):
            log.warning("%d table writes not registered: identity incomplete", len(writes) - len(complete))
        try:
            self.record("table_writes", complete)
        except Exception:
            log.exception("table writes could not be registered")
            return 0
        return len(complete)

    # Schema registration

    def register_schema(self, subject: str, schema_json: str | None) -> str | None:
        """New version if the schema differs from the subject's last one; its id, or None. Never fails a write."""
        if not is_present(schema_json) or not is_present(subject):
            return None
        if self._schemas.get(subject, (None, None))[0] == schema_json:  # registered by this ledger already
            return self._schemas[subject][1]
        try:
            known = self.read("table_schemas").where(F.col("subject") == subject)
            last = known.agg(F.max_by(F.struct("version", "schema_json", "schema_id"), "version")).first()[0]
            if last is not None and last["schema_json"] == schema_json:
                self._schemas[subject] = (schema_json, last["schema_id"])
                return last["schema_id"]
            version = 1 if last is None else last["version"] + 1
            schema_id = f"{subject}#{version}"
            self.record(
                "table_schemas",
                [
                    {
                        "subject": subject,
                        "version": version,
                        "schema_json": schema_json,
                        "wrapped_json": wrap_schema(schema_json),
                        "schema_id": schema_id,
                        "registered_at": now(),
                    }
                ],
            )
            self._schemas[subject] = (schema_json, schema_id)
            return schema_id
        except Exception:
            log.exception("schema of %s could not be registered", subject)
            return None

    # Dead letters

    def failed(self, error: BaseException, topic: str, message: dict, table: str | None) -> None:
        """One message whose processing failed. Errors here are raised: nothing may get lost silently."""
        self.record(
            "dead_letters",
            [
                {
                    "original_topic": topic,
                    "original_partition": message.get("partition") or 0,
                    "original_offset": message.get("offset") or 0,
                    "failed_at": now(),
                    "exception_class": f"{type(error).__module__}.{type(error).__qualname__}",
                    "exception_message": str(error),
                    "exception_stack_trace": "".join(traceback.format_exception(error)),
                    "extract_job_id": normalized(message.get("extract_job_id")),
                    "extract_buffer_id": normalized(message.get("extract_buffer_id")),
                    "table_identity": table,
                    "original_payload": json.dumps(message, default=str),
                }
            ],
        )

    def reject(self, rows: DataFrame, payload: str, topic: str, reason: str, message: Column, table: str | None) -> None:
        """Rows that cannot be loaded, appended as dead letters by Spark; ``payload`` is their text column."""
        self.append("dead_letters", dead_letters(rows, payload, topic, reason, message, table))

    # Run metrics

    @contextmanager
    def observed(self, operation: str, table: str | None = None, buffer: str | None = None):
        """Times an operation and records its outcome; the body may set ``rows`` and ``outcome``."""
        metric = {"rows": None, "outcome": "success"}
        started = now()
        try:
            yield metric
        except BaseException:
            metric["outcome"] = "error"
            raise
        finally:
            try:
                self.record(
                    "run_metrics",
                    [
                        {
                            "operation": f"{operation}.records",
                            "table_identity": table,
                            "extract_buffer_id": normalized(buffer),
                            "outcome": metric["outcome"],
                            "rows": metric["rows"],
                            "started_at": started,
                            "ended_at": now(),
                        }
                    ],
                )
            except Exception:
                log.exception("run metric of %s could not be recorded", operation)


def normalized(value: str | None) -> str:
    return value if is_present(value) else UNKNOWN


def dead_letters(
    rows: DataFrame, payload: str, topic: str, reason: str, message: Column, table: str | None
) -> DataFrame:
    def lineage(name: str):
        column = F.col(name) if name in rows.columns else F.lit(None).cast("string")
        return F.coalesce(F.nullif(F.trim(column), F.lit("")), F.lit(UNKNOWN)).alias(name.lstrip("_"))

    job = "extract_job_id" if "extract_job_id" in rows.columns else "_extract_job_id"
    buffer = "extract_buffer_id" if "extract_buffer_id" in rows.columns else "_extract_buffer_id"
    return rows.select(
        F.lit(topic).alias("original_topic"),
        F.lit(0).alias("original_partition"),
        F.lit(0).cast("bigint").alias("original_offset"),
        F.current_timestamp().alias("failed_at"),
        F.lit(reason).alias("exception_class"),
        message.alias("exception_message"),
        F.lit(None).cast("string").alias("exception_stack_trace"),
        lineage(job),
        lineage(buffer),
        F.lit(table).cast("string").alias("table_identity"),
        F.col(payload).alias("original_payload"),
    )


# What a registration must carry.
WRITE_IDENTITY = (
    "source_instance_name",
    "source_database_name",
    "source_schema_name",
    "source_table_name",
    "database_name",
    "namespace_name",
    "table_name",
)
BRONZE_TIMES = ("extract_start_at", "extract_end_at")


def write_complete(write: dict) -> bool:
    identified = all(is_present(write.get(name)) for name in WRITE_IDENTITY)
    timed = write.get("write_type") != "bronze" or all(write.get(name) for name in BRONZE_TIMES)
    return identified and timed


def schema_text(schema: T.StructType) -> str:
    return schema.json()
