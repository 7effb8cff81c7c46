"""The two streams: file-flush notifications → bronze, table-updated notifications → silver.

A notification is a control record of a few hundred bytes; a micro-batch brings at most as many as its source
option allows, and those are what the driver looks at. The change data they name only ever moves between
executors. Checkpoints replace committed offsets: a batch that fails is run again. A load is named by its files and written down
before it begins, when its rows are in the table, and when it is announced. A batch that is run again goes on from there: files
that were announced are left alone, loads that are whole are announced, others are repeated under their name and day, which
replaces what they left. So rows are loaded once, and every buffer is announced, once or more; silver does not change when a buffer
is applied twice.
"""

from __future__ import annotations

import hashlib
import logging
import re
from collections import defaultdict
from collections.abc import Callable
from datetime import date, timezone
from fnmatch import fnmatch
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.connect import connect_fields, row_schema
from tidemark.functions.naming import bronze_fqn, split_fqn, table_fqn_from_file_name, value_subject
from tidemark.plans.bronze import BronzeWrite, LoadedError, bronze_registration, ingest_bronze, table_updated
from tidemark.plans.ledger import Ledger, now, schema_text
from tidemark.plans.silver import transform_buffers
from tidemark.sources.messages import (
    ABANDONED,
    ANNOUNCED,
    FILE_FLUSH,
    FLUSH_TOPIC,
    LOADED,
    TABLE_LOADED,
    UPDATED_TOPIC,
    file_messages,
    parse_messages,
    to_messages,
)
from tidemark.sources.raw import envelope_schema
from tidemark.spec import ScdSpec

log = logging.getLogger(__name__)

#: Seconds that an announced file may be absent.
WAIT = 10.0


def start_bronze(
    spark: SparkSession,
    store,
    ledger: Ledger,
    inbox: str,
    outbox: str | Callable[[DataFrame], None],
    checkpoint: str,
    spec: ScdSpec = ScdSpec(),
    messages: DataFrame | None = None,
    once: bool = True,
    declared_only: bool = False,
    wait: float = WAIT,
) -> StreamingQuery:
    """Stream flush notifications into bronze tables; announces each buffer in ``outbox``: a folder for JSON
    lines, or a function that writes rows of ``key`` and ``value``, to a topic for instance.

    ``declared_only``: read files by their notification's schema document alone. That spares the inference pass
    over the raw files, and fields the document does not name are not loaded.

    A file that is not there yet is looked for again with the next records and at the next start; one that is still absent
    ``wait`` seconds after it was first looked for becomes a dead letter.
    """
    messages = file_messages(spark, inbox, FILE_FLUSH) if messages is None else messages
    if ledger.waiting_files():
        bronze_batch(spark, store, ledger, None, outbox, spec, declared_only, wait)

    def process(batch: DataFrame, _: int) -> None:
        bronze_batch(spark, store, ledger, batch, outbox, spec, declared_only, wait)

    return _start(messages, process, checkpoint, once)


def start_silver(
    spark: SparkSession,
    store,
    ledger: Ledger,
    inbox: str,
    checkpoint: str,
    spec: ScdSpec = ScdSpec(),
    messages: DataFrame | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Stream table-updated notifications into the silver tables."""
    messages = file_messages(spark, inbox, TABLE_LOADED) if messages is None else messages

    def process(batch: DataFrame, _: int) -> None:
        silver_batch(spark, store, ledger, batch, spec)

    return _start(messages, process, checkpoint, once)


def _start(messages: DataFrame, process, checkpoint: str, once: bool) -> StreamingQuery:
    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def _records(batch: DataFrame, ledger: Ledger, topic: str) -> list[dict]:
    """The batch's notifications; unreadable ones go to the dead letters."""
    unreadable = batch.where(~F.col("_parsed"))
    if not unreadable.isEmpty():
        ledger.reject(unreadable, "_payload", topic, "ValueError", F.lit("not a notification record"), None)
    return [row.asDict() for row in batch.where("_parsed").collect()]


def bronze_batch(
    spark: SparkSession,
    store,
    ledger: Ledger,
    batch: DataFrame | None,
    outbox: str | Callable[[DataFrame], None],
    spec: ScdSpec = ScdSpec(),
    declared_only: bool = False,
    wait: float = WAIT,
) -> None:
    """Load what a batch of notifications names, and the files that earlier ones named in vain."""
    records = [] if batch is None else _records(batch, ledger, FLUSH_TOPIC)
    awaited = ledger.waiting_files()
    if awaited:
        again = spark.createDataFrame([(text,) for text, _ in awaited.values()], "value string")
        records = _records(parse_messages(again, FILE_FLUSH), ledger, FLUSH_TOPIC) + records
    # A file that is named twice is loaded once.
    flushes = list({f["raw_file_path"]: f for f in reversed(records)}.values())[::-1]
    flushes = _there(spark, ledger, flushes, awaited, wait)
    if not flushes:
        return
    store.refresh()
    begun = ledger.loads_of_files([f["raw_file_path"] for f in flushes])
    groups = defaultdict(list)
    for flush in flushes:
        load = begun.get(flush["raw_file_path"])
        if load and ANNOUNCED in load["states"]:
            log.info("%s is loaded already", flush["raw_file_path"])
            continue
        try:
            source = _source_table(flush)
        except Exception as error:
            ledger.failed(error, FLUSH_TOPIC, flush, flush.get("table_name"))
            continue
        groups[(source, flush["value_schema"], load["load"] if load else None)].append(flush)
    for (source, value_schema, _), group in groups.items():
        schema = None
        if declared_only and connect_fields(value_schema):
            schema = envelope_schema(row_schema(value_schema))
        stopped = begun.get(group[0]["raw_file_path"])

        def load(flushes: list[dict], last_try: bool) -> bool:
            return _load(
                spark, store, ledger, source, value_schema, schema, flushes, outbox, spec, last_try, stopped
            )

        # All files of a table in one pass; one by one only if that fails, to find the one at fault.
        if not load(group, len(group) == 1):
            # What failed has left no rows; without this mark a later batch would repeat it beside the single loads.
            target = bronze_fqn(source)
            name = stopped["load"] if stopped else load_name(target, [f["raw_file_path"] for f in group])
            ledger.mark_loads(ABANDONED, target, [(name, None)])
            stopped = None
            for flush in group:
                load([flush], True)


def _there(spark: SparkSession, ledger: Ledger, flushes: list[dict], awaited: dict, wait: float) -> list[dict]:
    """Notifications whose files are there. The others are waited for, or, when that took too long, dead letters."""
    found, changed = [], []
    for flush in flushes:
        path, text, seen = flush["raw_file_path"], flush["_payload"], now()
        since = awaited[path][1].astimezone(timezone.utc) if path in awaited else seen
        if _exists(spark, path):
            found.append(flush)
            changed += [(path, text, since, False)] if path in awaited else []
        elif (seen - since).total_seconds() >= wait:
            try:
                with ledger.observed("table_writer.process_record", flush.get("table_name"), flush.get("extract_buffer_id")):
                    raise FileNotFoundError(f"{path} was not there within {wait} seconds")
            except FileNotFoundError as error:
                ledger.failed(error, FLUSH_TOPIC, flush, flush.get("table_name"))
            changed += [(path, text, since, False)] if path in awaited else []
        elif path not in awaited:
            changed.append((path, text, since, True))
    if changed:
        ledger.wait_for(changed)
    return found


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    matching = location.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(location)
    return matching is not None and len(matching) > 0


def _source_table(flush: dict) -> str:
    """The table a raw file belongs to: from its name, else as the notification says."""
    named = table_fqn_from_file_name(flush["raw_file_path"].rsplit("/", 1)[-1])
    try:
        return ".".join(split_fqn(named))
    except ValueError:
        return ".".join(split_fqn(flush["table_name"] or named))


def load_name(table: str, paths: list[str]) -> str:
    """The same for the same files, so that a batch that is run again replaces what it loaded."""
    return hashlib.sha256("\n".join([table, *sorted(paths)]).encode()).hexdigest()[:32]


def _plain(path: str) -> str:
    return unquote(re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "", path)).rstrip("/")


def named_by(notified: str, file: str) -> bool:
    """Whether a raw file is what a notification names: by its path, its folder or a pattern; schemes aside."""
    notified, file = _plain(notified), _plain(file)
    return file == notified or file.startswith(notified + "/") or fnmatch(file, notified)


def _load(spark, store, ledger, source, value_schema, schema, flushes, outbox, spec, last_try, stopped=None) -> bool:
    """True when done with these files: loaded, or, on the last try, put among the dead letters.

    ``stopped`` is an earlier load of these files that was not announced: if its rows are in the table, they are announced; else it is
    repeated whole, so that whatever rows it left are replaced.
    """
    buffer = flushes[0]["extract_buffer_id"] if len(flushes) == 1 else None
    target = bronze_fqn(source)
    paths = stopped["paths"] if stopped else [f["raw_file_path"] for f in flushes]
    name = stopped["load"] if stopped else load_name(target, paths)
    loaded_at = stopped["loaded_at"] if stopped else now()
    whole = stopped is not None and LOADED in stopped["states"]
    if not whole:
        try:
            with ledger.observed("table_writer.process_record", source, buffer) as metric:
                write = ingest_bronze(spark, store, paths, source, ledger, value_schema, schema, loaded_at, name, spec)
                metric["rows"] = write.rows
        except LoadedError:
            raise  # the rows are there: only the same load may be repeated, so the batch is
        except Exception as error:
            if last_try:
                ledger.failed(error, FLUSH_TOPIC, flushes[0], source)
            return last_try
    files = ledger.loads_of_files([f["raw_file_path"] for f in flushes])[flushes[0]["raw_file_path"]]["files"].values()
    table_schema = store.schema(target)
    schema_id = ledger.register_schema(value_subject(*split_fqn(target)), schema_text(table_schema))
    write = BronzeWrite(target, sum(r.row_count for r in files), 0, 0, schema_id)
    today = spark.range(1).select(*(f(F.lit(loaded_at)) for f in (F.year, F.month, F.dayofmonth))).first()
    own = [[r for r in files if named_by(f["raw_file_path"], r.raw_file_path)] for f in flushes]
    rows = [sum(r.row_count for r in group) for group in own]
    told = [f | _range(f, group) for f, group in zip(flushes, own)]
    of_buffer = defaultdict(int)
    for r in files:
        of_buffer[r.extract_buffer_id] += r.row_count
    sent = [table_updated(f, write, store, None, date(*today), of_buffer[f["extract_buffer_id"]]) for f in told]
    announce(spark, sent, outbox)
    ledger.mark_loads(ANNOUNCED, target, [(name, None)])
    root = getattr(store, "root", None)
    ledger.register_writes([bronze_registration(f, write, n, root, schema_text(table_schema)) for f, n in zip(told, rows)])
    return True


def _range(flush: dict, files: list) -> dict:
    """The sequence range of a notification that does not give it, as its raw files have it."""
    lows, highs = [r.source_min_lsn for r in files if r.source_min_lsn is not None], [r.source_max_lsn for r in files if r.source_max_lsn is not None]
    found = {"source_min_lsn": min(lows, default=None), "source_max_lsn": max(highs, default=None)}
    return {name: value for name, value in found.items() if flush.get(name) is None}


def announce(spark: SparkSession, notifications: list[dict], outbox: str | Callable[[DataFrame], None]) -> None:
    """Publish table-updated records, keyed by buffer. A failure fails the batch: its buffers would be lost."""
    rows = [tuple(n.get(f.name) for f in TABLE_LOADED.fields) for n in notifications]
    messages = to_messages(spark.createDataFrame(rows, TABLE_LOADED)).coalesce(1)
    if callable(outbox):
        outbox(messages)
    else:
        messages.select("value").write.mode("append").text(outbox)


def silver_batch(spark: SparkSession, store, ledger: Ledger, batch: DataFrame, spec: ScdSpec = ScdSpec()) -> None:
    groups = defaultdict(list)
    for message in _records(batch, ledger, UPDATED_TOPIC):
        groups[message["table_fqn"]].append(message)
    for table, group in groups.items():
        group.sort(key=lambda m: (m["source_min_lsn"] is None, m["source_min_lsn"] or 0))
        if not _apply(spark, store, ledger, table, group, spec, last_try=len(group) == 1):
            for message in group:
                _apply(spark, store, ledger, table, [message], spec, last_try=True)


def _apply(spark, store, ledger, table, group, spec, last_try) -> bool:
    buffers = [m["extract_buffer_id"] for m in group]
    # Where bronze holds the buffers, if every record says so; this prunes its partitions.
    loads = [(m["extract_buffer_id"], m.get("load_date"), m.get("write_row_count")) for m in group]
    loads = loads if all(None not in load for load in loads) else None
    try:
        with ledger.observed("type2_dimension.process_record", table, ",".join(b for b in buffers if b)) as metric:
            write = transform_buffers(
                spark, store, table, buffers, spec, ledger, group[-1], loads, group
            )
            if write is None:
                metric["outcome"] = "skipped"
            else:
                metric["rows"] = write.type2_rows
    except Exception as error:
        if last_try:
            ledger.failed(error, UPDATED_TOPIC, group[0], table)
        return last_try
    return True
