"""Tables as Parquet folders, or in a catalog with row-level merges.

``FolderStore`` needs nothing but a shared file system. Every change of a table is one Spark write that replaces exactly the
partitions it brings (dynamic partition overwrite), so a write that is repeated leaves the same table. There are three layouts:

* *log* (bronze): partitions for load date, load and key bucket. A load that is repeated replaces itself.
* *keyed* (type 1): a partition for each key bucket; an upsert rewrites the buckets its keys fall into.
* *history* (type 2): the last version of each key in one partition for each bucket, the versions before it in partitions that are
  only added. What an increment writes depends on its keys and their new versions, not on their history. A closed version counts while
  its number is below that of its key's last one and it is of the key's present generation: versions that a rebuild of the key
  replaced are of an older one. The number of versions of a key stands in its last one, and readers join it.

Schemas are rows of a table of their own, ``_tables``; the latest one of a table holds. A column that changes from text to a type that files
of text cannot be read as goes on under another stored name, and reads as either; so no change of a schema touches a file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import split_fqn, table_path
from tidemark.operators.evolve import Evolution, convert
from tidemark.operators.silver import merge_upsert, refuse_repeated
from tidemark.sources.fields import record
from tidemark.spec import DATE_PARTITIONS, GENERATION, RAW_FILE, RECORD_COUNT, RECORD_NUMBER, VERSION_KEY

BUCKET, LOAD, SIDE = "_bucket", "_load", "_side"
HIDDEN = (BUCKET, LOAD, SIDE, GENERATION, RAW_FILE)
TIP, CLOSED = "tip", "closed"
#: Partition of the last versions, which belong to no single load.
NO_LOAD = "-"
#: Begins the names of loads that no index knows, and the bucket of rows whose keys were not looked at.
UNINDEXED = "unindexed-"
ANY_BUCKET = -1

LOG, KEYED, HISTORY = "log", "keyed", "history"
PARTITIONS = {LOG: (*DATE_PARTITIONS, LOAD, BUCKET), KEYED: (BUCKET,), HISTORY: (SIDE, BUCKET, LOAD)}
STORED = {
    LOG: record("_raw_file string, _load string, _bucket int"),
    KEYED: record("_bucket int"),
    HISTORY: record("_generation bigint, _side string, _bucket int, _load string"),
}
TABLES = record("fqn string, version int, layout string, columns string, older string, keys array<string>, buckets int")


@dataclass(frozen=True)
class Table:
    """What the store knows of a table. ``older``: for retyped columns, stored names and types before the present one."""

    fqn: str
    layout: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int
    version: int = 1
    older: dict[str, list[dict]] = field(default_factory=dict)

    def stored_name(self, column: str) -> str:
        return f"{column}__{len(self.older[column])}" if column in self.older else column

    def older_fields(self, column: str) -> list[T.StructField]:
        return [T.StructField.fromJson(f) for f in self.older.get(column, ())]

    def stored_schema(self) -> T.StructType:
        fields = []
        for f in self.schema.fields:
            retyped = f.name in self.older
            fields.append(T.StructField(self.stored_name(f.name), f.dataType, True, {} if retyped else f.metadata))
            fields += self.older_fields(f.name)
        return T.StructType([*fields, *STORED[self.layout].fields])

    def shown(self, stored: DataFrame) -> DataFrame:
        """Stored rows with the table's columns, hidden ones included."""
        columns = []
        for f in self.schema.fields:
            value = F.col(f"`{self.stored_name(f.name)}`")
            if f.name in self.older:
                earlier = reversed(self.older_fields(f.name))
                value = F.coalesce(value, *(convert(F.col(f"`{e.name}`"), e.dataType, f.dataType) for e in earlier))
            columns.append(value.alias(f.name))
        return stored.select(*columns, *(F.col(f.name) for f in STORED[self.layout].fields))


class FolderStore:
    """One folder per table under ``root/database/namespace/table``; a single writer per table."""

    table_format = "parquet"

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, log_buckets: int = 16):
        """``log_buckets`` are those of each load of a log; fewer than ``buckets``, as they multiply with the loads."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.log_buckets = min(log_buckets, buckets)
        self._tables: dict[str, Table] | None = None

    # Tables

    def path(self, fqn: str) -> str:
        return table_path(self.root, fqn)

    def refresh(self) -> None:
        """Look up the present schemas: another job may write the tables that this one reads. One row for each table."""
        try:
            rows = self.spark.read.schema(TABLES).parquet(f"{self.root}/_tables")
        except AnalysisException:  # no table yet
            self._tables = {}
            return
        latest = rows.groupBy("fqn").agg(F.max_by(F.struct(*TABLES.fieldNames()), "version").alias("t"))
        self._tables = {r.t.fqn: _table(r.t) for r in latest.collect()}

    def exists(self, fqn: str) -> bool:
        if self._tables is None or fqn not in self._tables:
            self.refresh()
        return fqn in self._tables

    def _known(self, fqn: str) -> Table:
        if not self.exists(fqn):
            raise ValueError(f"no such table: {fqn}")
        return self._tables[fqn]

    def _save(self, table: Table) -> None:
        row = (table.fqn, table.version, table.layout, table.schema.json(), json.dumps(table.older), list(table.keys), table.buckets)
        self.spark.createDataFrame([row], TABLES).coalesce(1).write.mode("append").parquet(f"{self.root}/_tables")
        self._tables[table.fqn] = table

    def schema(self, fqn: str) -> T.StructType:
        return self._known(fqn).schema

    def evolve(self, fqn: str, plan: Evolution) -> None:
        """Take over an evolved schema; no file is rewritten. Added columns read as their default from older files, widened ones are
        widened by the reader, and retyped ones go on under another stored name."""
        if not plan.changed:
            return
        table = self._known(fqn)
        older = dict(table.older)
        for name in plan.rewritten:
            before = T.StructField(table.stored_name(name), table.schema[name].dataType)
            older[name] = [*older.get(name, []), before.jsonValue()]
        self._save(replace(table, schema=plan.schema, older=older, version=table.version + 1))

    # Reads

    def read(self, fqn: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The table without its hidden columns; with buckets given, only those folders are read."""
        rows = self._rows(fqn, buckets)
        if self._known(fqn).layout == HISTORY:
            rows = _counting(rows, self._known(fqn).keys)
        return rows.drop(*HIDDEN)

    def tips(self, fqn: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The last version of each key, with the generation of its history."""
        return self._rows(fqn, buckets).where(F.col(SIDE) == TIP).drop(SIDE, BUCKET, LOAD)

    def read_log(
        self, fqn: str, days: Iterable[tuple] | None = None, loads: Iterable[str] | None = None, buckets: Iterable[int] | None = None
    ) -> DataFrame:
        """A log's rows with hidden columns: those of some days, loads or key buckets only, by partition. Loads that
        no index knows are always among them."""
        rows = self._rows(fqn)
        outside = F.col(LOAD).startswith(UNINDEXED)
        if days is not None:
            wanted = outside
            for year, month, day in days:
                wanted = wanted | ((F.col("_year") == year) & (F.col("_month") == month) & (F.col("_day") == day))
            rows = rows.where(wanted)
        if loads is not None:
            rows = rows.where(outside | F.col(LOAD).isin(*loads))
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(ANY_BUCKET, *buckets))
        return rows

    def _rows(self, fqn: str, buckets: Iterable[int] | None = None) -> DataFrame:
        table = self._known(fqn)
        try:
            stored = self.spark.read.schema(table.stored_schema()).parquet(self.path(fqn))
        except AnalysisException:  # known, but nothing was written
            stored = self.spark.createDataFrame([], table.stored_schema())
        rows = table.shown(stored)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(*buckets))

    # Writes

    def bucket_of(self, fqn: str, keys: Iterable[str | Column], layout: str = KEYED) -> Column:
        """Key bucket of a row; of the key's text, so that a widened key stays where it was."""
        if self._tables is None:
            self.refresh()
        count = self._tables[fqn].buckets if fqn in self._tables else self.log_buckets if layout == LOG else self.buckets
        texts = ((F.col(k) if isinstance(k, str) else k).cast("string") for k in keys)
        return F.pmod(F.xxhash64(*texts), F.lit(count)).cast("int").alias(BUCKET)

    def create_append(self, fqn: str, rows: DataFrame, load: str | None = None, bucket: Column | None = None) -> None:
        """Add a load's rows to a log, making it first if it is new. A load of the same name is replaced, in the partitions of its rows."""
        self._create(fqn, rows, LOG, ())
        hidden = {LOAD: F.lit(load or UNINDEXED + uuid.uuid4().hex), BUCKET: F.lit(ANY_BUCKET) if bucket is None else bucket}
        if RAW_FILE not in rows.columns:
            hidden[RAW_FILE] = F.lit(None).cast("string")
        self._write(fqn, rows.withColumns(hidden))

    def upsert(self, fqn: str, rows: DataFrame, keys: Iterable[str], buckets: Iterable[int] | None = None) -> None:
        """Replace or add one row for each key. ``buckets`` are those of the rows' keys, if the caller has them already."""
        keys = list(keys)
        known = self.exists(fqn)
        if not known:
            self._create(fqn, rows, KEYED, keys)
            content = refuse_repeated(rows, keys)
        else:
            # At most one value per bucket of the table comes back, whatever the number of keys.
            buckets = self._buckets_of(fqn, rows, keys) if buckets is None else buckets
            content = merge_upsert(self.read(fqn, buckets), rows, keys)
        self._write(fqn, content.select("*", self.bucket_of(fqn, keys)))

    def write_history(
        self, fqn: str, rows: DataFrame, keys: Iterable[str], load: str, buckets: Iterable[int] | None = None
    ) -> None:
        """Take over new versions of some keys: each key's last one, and those between its stored last one and that.

        ``rows`` hold the ``_generation`` of each key's history. Last versions replace those of the same keys; the
        rows of the buckets concerned that belong to other keys are written again, a row for each key.
        """
        keys = list(keys)
        known = self.exists(fqn)
        if not known:
            self._create(fqn, rows, HISTORY, keys)
        bucket = self.bucket_of(fqn, keys)
        last = F.col(RECORD_NUMBER) == F.col(RECORD_COUNT)
        side = {SIDE: F.when(last, TIP).otherwise(CLOSED), LOAD: F.when(last, NO_LOAD).otherwise(load), BUCKET: bucket}
        new = rows.withColumns(side)
        if known:
            buckets = self._buckets_of(fqn, rows, keys) if buckets is None else buckets
            tips = self._rows(fqn, buckets).where(F.col(SIDE) == TIP)
            others = tips.join(rows.where(last).select(*keys), keys, "left_anti")
            new = new.unionByName(others, allowMissingColumns=True)
        self._write(fqn, new)

    def _buckets_of(self, fqn: str, rows: DataFrame, keys: list[str]) -> list[int]:
        return [r[0] for r in rows.select(self.bucket_of(fqn, keys)).distinct().collect()]

    def _create(self, fqn: str, rows: DataFrame, layout: str, keys: Iterable[str]) -> None:
        if not self.exists(fqn):
            fields = [f for f in rows.schema.fields if f.name not in HIDDEN]
            count = self.log_buckets if layout == LOG else self.buckets
            self._save(Table(fqn, layout, T.StructType(fields), tuple(keys), count))

    def _write(self, fqn: str, rows: DataFrame) -> None:
        """One write, which replaces the partitions of its rows. Rebalancing spreads a large partition over many files, and gathers
        small ones."""
        table = self._known(fqn)
        stored = rows.withColumnsRenamed({name: table.stored_name(name) for name in table.older})
        partitions = PARTITIONS[table.layout]
        writer = stored.hint("rebalance", *partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(self.path(fqn))


def _table(row) -> Table:
    schema = T.StructType.fromJson(json.loads(row.columns))
    return Table(row.fqn, row.layout, schema, tuple(row.keys), row.buckets, row.version, json.loads(row.older))


def _counting(rows: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The versions of a history that count, with the number of versions of their keys: one row for each key is joined."""
    tips, closed = rows.where(F.col(SIDE) == TIP), rows.where(F.col(SIDE) == CLOSED)
    last = tips.select(
        *keys, F.col(RECORD_NUMBER).alias("_tip_number"), F.col(RECORD_COUNT).alias("_tip_count"), F.col(GENERATION).alias("_tip_generation")
    )
    counts = (F.col(RECORD_NUMBER) < F.col("_tip_number")) & (F.col(GENERATION) == F.col("_tip_generation"))
    joined = closed.join(last, list(keys)).where(counts).withColumn(RECORD_COUNT, F.col("_tip_count"))
    return tips.unionByName(joined.select(*rows.columns))


class CatalogStore:
    """The same operations on a catalog whose tables support row-level MERGE (not part of plain Spark)."""

    def __init__(self, spark: SparkSession, catalog: str, provider: str):
        self.spark = spark
        self.catalog = catalog
        self.provider = self.table_format = provider

    def name(self, fqn: str) -> str:
        return ".".join(f"`{part}`" for part in (self.catalog, *split_fqn(fqn)))

    def path(self, fqn: str) -> str:
        return self.name(fqn)

    def refresh(self) -> None:
        """Nothing to look up: the catalog does."""

    def exists(self, fqn: str) -> bool:
        return self.spark.catalog.tableExists(self.name(fqn))

    def schema(self, fqn: str) -> T.StructType:
        return self.read(fqn).schema

    def read(self, fqn: str, buckets: Iterable[int] | None = None) -> DataFrame:
        self.spark.catalog.refreshTable(self.name(fqn))
        return self.spark.table(self.name(fqn)).drop(*HIDDEN)

    def tips(self, fqn: str, buckets: Iterable[int] | None = None) -> DataFrame:
        return self.read(fqn).where(F.col(RECORD_NUMBER) == F.col(RECORD_COUNT))

    def read_log(self, fqn: str, days=None, loads=None, buckets=None) -> DataFrame:
        self.spark.catalog.refreshTable(self.name(fqn))
        rows = self.spark.table(self.name(fqn))
        if days is not None:
            dates = F.struct(*DATE_PARTITIONS)
            rows = rows.where(F.lit(False) if not days else dates.isin(*(F.struct(*map(F.lit, d)) for d in days)))
        return rows if loads is None else rows.where(F.col(LOAD).isin(*loads))

    def create_append(self, fqn: str, rows: DataFrame, load: str | None = None, bucket: Column | None = None) -> None:
        """Add a load's rows; rows that an earlier try of the same load left are replaced in the same commit."""
        load = load or UNINDEXED + uuid.uuid4().hex
        writer = rows.withColumn(LOAD, F.lit(load)).writeTo(self.name(fqn))
        if self.exists(fqn):
            writer.overwrite(F.col(LOAD) == load)
        else:
            writer.using(self.provider).partitionedBy(*(F.col(p) for p in DATE_PARTITIONS), F.col(LOAD)).create()

    def upsert(self, fqn: str, rows: DataFrame, keys: Iterable[str], buckets: Iterable[int] | None = None) -> None:
        """Merge by key: matched rows take every other incoming column; target-only columns stay."""
        keys = list(keys)
        if not self.exists(fqn):
            refuse_repeated(rows, keys).writeTo(self.name(fqn)).using(self.provider).create()
            return
        changed = {c: F.col(f"s.`{c}`") for c in rows.columns if c not in keys}
        merging = refuse_repeated(rows, keys).alias("s").mergeInto(self.name(fqn), self._matching(fqn, keys))
        merging.whenMatched().update(changed).whenNotMatched().insertAll().merge()

    def _matching(self, fqn: str, columns: Iterable[str]) -> Column:
        return F.expr(" AND ".join(f"{self.name(fqn)}.`{c}` = s.`{c}`" for c in columns))

    def write_history(
        self, fqn: str, rows: DataFrame, keys: Iterable[str], load: str, buckets: Iterable[int] | None = None
    ) -> None:
        """Merge versions, drop those that a rebuild of their key no longer has, and bring the counts of the others up to date."""
        keys, rows = list(keys), rows.drop(GENERATION)
        if self.exists(fqn):
            number = F.col(f"{self.name(fqn)}.`{RECORD_NUMBER}`")
            first = rows.groupBy(*keys).agg(F.min(RECORD_NUMBER).alias("_first"), F.max(RECORD_COUNT).alias("_count"))
            stale = self.read(fqn).join(first, keys).where(F.col(RECORD_NUMBER) >= F.col("_first")).select(VERSION_KEY)
            stale = stale.join(rows.select(VERSION_KEY), VERSION_KEY, "left_anti")
            stale.alias("s").mergeInto(self.name(fqn), self._matching(fqn, [VERSION_KEY])).whenMatched().delete().merge()
            older = first.alias("s").mergeInto(self.name(fqn), self._matching(fqn, keys))
            older.whenMatched(number < F.col("s._first")).update({RECORD_COUNT: F.col("s._count")}).merge()
        self.upsert(fqn, rows, [VERSION_KEY])

    def bucket_of(self, fqn: str, keys: Iterable[str | Column], layout: str = KEYED) -> Column:
        """No buckets: which files a key is in is the table format's business."""
        return F.lit(ANY_BUCKET).alias(BUCKET)

    def evolve(self, fqn: str, plan: Evolution) -> None:
        fields = {f.name: f for f in plan.schema.fields}
        for name in plan.added:
            default = fields[name].metadata.get("CURRENT_DEFAULT")
            self.spark.sql(
                f"ALTER TABLE {self.name(fqn)} ADD COLUMN `{name}` {fields[name].dataType.simpleString()}"
            )
            if default is not None:
                self.spark.sql(f"UPDATE {self.name(fqn)} SET `{name}` = {default} WHERE `{name}` IS NULL")
        for name in (*plan.widened, *plan.rewritten):
            self.spark.sql(
                f"ALTER TABLE {self.name(fqn)} ALTER COLUMN `{name}` TYPE {fields[name].dataType.simpleString()}"
            )
