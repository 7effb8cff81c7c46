"""Bronze and silver tables end to end, on a folder store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.envelopes import V1, V2, V3, envelope, write_lines
from tidemark.functions.connect import row_schema
from tidemark.operators.evolve import SILVER, SchemaIncompatibleError, desired_columns, plan_evolution
from tidemark.plans.bronze import ingest_bronze
from tidemark.plans.ledger import Ledger
from tidemark.plans.silver import SilverWrite, rebuild_silver, transform_buffers
from tidemark.plans.store import FolderStore
from tidemark.sources.raw import envelope_schema
from tidemark.spec import ScdSpec

SOURCE = "geo.public.scalars"
BRONZE = "geo.public_bronze.scalars"
TYPE2 = "geo.public_silver.scalars_type2"
TYPE1 = "geo.public_silver.scalars_type1"
SPEC = ScdSpec()


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.store = FolderStore(spark, str(folder / "lake"), buckets=4)
        self.ledger = Ledger(spark, str(folder / "ledger"))
        self.files = 0

    def load(self, *envelopes, schema=None, value_schema=None):
        self.files += 1
        path = write_lines(str(self.folder / f"{SOURCE}-2026-05-31_02-51-21-000-{self.files:06d}.jsonl"), envelopes)
        return ingest_bronze(self.spark, self.store, path, SOURCE, self.ledger, value_schema, schema)

    def apply(self, *buffers, **message):
        return transform_buffers(self.spark, self.store, BRONZE, list(buffers), SPEC, self.ledger, message)

    def run(self, buffer, *envelopes, **kwargs):
        self.load(*envelopes, **kwargs)
        return self.apply(buffer)

    def rows(self, table, *columns):
        df = self.store.read(table)
        shown = [F.col(c).cast("string").alias(c) if c.startswith("_valid") else F.col(c) for c in columns]
        return [tuple(r) for r in df.orderBy("id", "_source_lsn").select(*shown).collect()]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_versions_deletes_and_replays(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]))
    assert lake.rows(TYPE2, "primary_key", "_is_current", "_valid_from", "_record_number", "_record_count") == [
        ("1-32591512", True, "2026-05-31 02:27:24.24287", 1, 1)
    ]
    lake.run("buf-2", envelope("buf-2", "u", 1, V2[1], V2[0]))
    lake.run("buf-7", envelope("buf-7", "u", 1, V3[1], V3[0], name="three"))
    columns = ("_valid_from", "_valid_to", "_is_current", "_record_number", "_record_count", "natural_key")
    three = [
        ("2026-05-31 02:27:24.24287", "2026-05-31 03:27:24.242869", False, 1, 3, 1),
        ("2026-05-31 03:27:24.24287", "2026-05-31 04:27:24.242869", False, 2, 3, 1),
        ("2026-05-31 04:27:24.24287", "9999-12-31 23:59:59.999999", True, 3, 3, 1),
    ]
    assert lake.rows(TYPE2, *columns) == three
    assert lake.rows(TYPE1, "name", "_record_number", "_record_count") == [("three", 3, 3)]
    # A replay changes nothing, and needs no more than the ledger to know.
    assert lake.apply("buf-1") == SilverWrite(TYPE2, TYPE1, 0, 0, 0, False)
    assert lake.rows(TYPE2, *columns) == three
    # The same changes as another buffer are late: their key is rebuilt from bronze.
    lake.load(envelope("buf-1-again", "u", 1, V1[1], V1[0]))
    assert lake.apply("buf-1-again").rebuilt
    assert lake.rows(TYPE2, *columns) == three
    assert not {"_is_current", "_valid_from", "_valid_to", "_bucket"} & set(lake.store.read(TYPE1).columns)

    assert not lake.run("buf-8", envelope("buf-8", "d", 1, V3[1] + 500, ts_ms=1780202844583)).rebuilt
    after = lake.rows(TYPE2, "primary_key", "_valid_to", "_is_current", "_is_deleted", "_record_number")
    assert after[-1] == ("1-32596512", "2026-05-31 04:47:24.583", False, True, 3)
    assert lake.rows(TYPE1, "_is_deleted", "primary_key") == [(True, "1-32596512")]
    lake.apply("buf-8")
    lake.apply("buf-2", "buf-7")
    assert lake.rows(TYPE2, "primary_key", "_valid_to", "_is_current", "_is_deleted", "_record_number") == after


def test_same_stamp_refreshes_lineage_only(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]))
    before = lake.rows(TYPE2, "version_key", "_valid_from", "_valid_to")
    lake.run("buf-6", envelope("buf-6", "r", 1, 32595512, V1[0], job="job-2", kind="snapshot"))
    assert lake.rows(TYPE2, "version_key", "_valid_from", "_valid_to") == before
    for table in (TYPE2, TYPE1):
        assert lake.rows(table, "_extract_job_id", "_extract_buffer_id", "_extract_type") == [
            ("job-2", "buf-6", "snapshot")
        ]


def test_delete_of_unknown_key_leaves_a_tombstone(lake):
    lake.run("buf-4", envelope("buf-4", "d", 3, 32591512))
    shown = ("id", "primary_key", "_is_current", "_is_deleted", "_valid_from", "_valid_to", "_record_number")
    expected = [(3, "3-32591512", True, True, "1970-01-01 00:00:00", "2026-05-31 02:27:24.583", 1)]
    assert lake.rows(TYPE2, *shown) == expected
    lake.apply("buf-4")
    assert lake.rows(TYPE2, *shown) == expected
    lake.run("buf-9", envelope("buf-9", "c", 3, 32599999, V3[0]))
    assert lake.rows(TYPE2, "_is_current", "_is_deleted") == [(False, True), (True, False)]


def test_older_stamp_of_a_new_key_still_loads(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]))
    lake.run("buf-5", envelope("buf-5", "c", 2, 32594000, "2026-05-30T01:00:00Z"))
    assert lake.rows(TYPE2, "id", "_is_current") == [(1, True), (2, True)]


def test_update_and_delete_in_one_buffer(lake):
    lake.run(
        "b", envelope("b", "c", 1, 10, V1[0]), envelope("b", "u", 1, 11, V2[0]), envelope("b", "d", 1, 12),
        envelope("b", "d", 2, 13), envelope("b", "c", 2, 14, V1[0]),
    )
    assert lake.rows(TYPE2, "id", "_is_current", "_is_deleted") == [
        (1, False, False), (1, False, True), (2, False, True), (2, True, False)
    ]


def test_new_column_is_null_before(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]))
    lake.run("buf-2", envelope("buf-2", "u", 1, V2[1], V2[0], extra=42))
    assert lake.rows(TYPE2, "extra") == [(None,), (42,)]
    lake.run("buf-7", envelope("buf-7", "u", 1, V3[1], V3[0]))
    assert lake.rows(TYPE2, "extra") == [(None,), (42,), (None,)]


def test_declared_default_fills_older_rows(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]))
    document = (
        '{"type":"struct","fields":[{"field":"after","type":"struct","fields":['
        '{"field":"id","type":"int64"},{"field":"status","type":"string","default":"it\'s new"},'
        '{"field":"level","type":"int32","default":7},{"field":"bad","type":"int32","default":"x"}]}]}'
    )
    lake.load(envelope("buf-2", "u", 1, V2[1], V2[0], status="old", level=1), value_schema=document)
    bronze = lake.store.read(BRONZE).orderBy("_source_lsn").select("after_status", "after_level").collect()
    assert [tuple(r) for r in bronze] == [("it's new", 7), ("old", 1)]


def test_widening_and_incompatible_change(lake):
    lake.load(envelope("a", "u", 1, 1, V1[0], value=1))
    lake.load(envelope("b", "u", 1, 2, V2[0], value=2))
    with pytest.raises(SchemaIncompatibleError, match="after_value"):
        lake.load(envelope("c", "u", 1, 3, V3[0], value="text"))
    assert lake.store.read(BRONZE).count() == 2


def test_same_file_twice_is_appended_twice_but_versioned_once(lake):
    for _ in range(2):
        lake.load(envelope("buf-1", "u", 1, V1[1], V1[0]))
    assert lake.store.read(BRONZE).count() == 2
    lake.apply("buf-1")
    assert len(lake.rows(TYPE2, "id")) == 1


def test_damaged_lines_and_keyless_changes_become_dead_letters(lake):
    keyless = envelope("buf-1", "t", None, 5)
    write = lake.load(envelope("buf-1", "u", 1, V1[1], V1[0]), "{broken", keyless)
    assert (write.rows, write.corrupt) == (2, 1)
    assert lake.apply("buf-1").keyless == 1
    letters = lake.ledger.read("dead_letters").orderBy("exception_class").collect()
    assert [(r["exception_class"], r["original_payload"][:7]) for r in letters] == [
        ("CorruptRecord", "{broken"), ("KeylessChange", letters[1]["original_payload"][:7])
    ]
    assert len(lake.rows(TYPE2, "id")) == 1


def test_unknown_and_missing_buffers(lake):
    lake.load(envelope("buf-1", "u", 1, V1[1], V1[0]))
    with pytest.raises(ValueError, match="no bronze rows"):
        lake.apply("nope")
    assert lake.apply() is None
    assert lake.apply(" ") is None


def test_rebuild_equals_increments(lake):
    lake.run("b1", *(envelope("b1", "c", k, k, V1[0]) for k in range(20)))
    lake.run("b2", *(envelope("b2", "u" if k % 3 else "d", k, 100 + k, V2[0]) for k in range(0, 20, 2)))
    shown = ("version_key", "_valid_to", "_is_current", "_is_deleted", "_record_number", "_record_count", "_last_lsn")
    before = (lake.rows(TYPE2, *shown), lake.rows(TYPE1, "id", "version_key", "_is_deleted"))
    rebuild_silver(lake.spark, lake.store, BRONZE, SPEC)
    assert (lake.rows(TYPE2, *shown), lake.rows(TYPE1, "id", "version_key", "_is_deleted")) == before


class Stopped(Exception):
    pass


def stop_at(monkeypatch, owner, name, number):
    """The ``number``-th call of a method stops the job instead."""
    real, calls = getattr(owner, name), []

    def call(*args, **kwargs):
        calls.append(name)
        if len(calls) == number:
            raise Stopped
        return real(*args, **kwargs)

    monkeypatch.setattr(owner, name, call)


@pytest.mark.parametrize(("owner", "step", "number"), [("store", "_write", 1), ("store", "_write", 2), ("ledger", "mark_loads", 1)])
def test_a_stop_at_any_step_leaves_readable_tables_and_is_made_good(lake, monkeypatch, owner, step, number):
    shown = ("id", "version_key", "_valid_to", "_is_current", "_record_number", "_record_count")
    lake.run("b1", *(envelope("b1", "c", k, k, V1[0]) for k in range(6)))
    before = lake.rows(TYPE2, *shown)
    lake.load(*(envelope("b2", "u", k, 100 + k, V2[0], more=k) for k in range(3, 9)))
    stop_at(monkeypatch, getattr(lake, owner), step, number)
    try:
        lake.apply("b2")
    except Stopped:
        pass
    monkeypatch.undo()
    left = lake.rows(TYPE2, *shown)
    lake.store.read(TYPE1).collect()
    lake.apply("b2")
    after = lake.rows(TYPE2, *shown)
    assert left in (before, after) and len(after) == 12
    assert sorted(r[0] for r in lake.store.read(TYPE1).select("id").collect()) == [*range(9)]


def test_versions_of_an_older_generation_do_not_count(lake):
    """Rebuilding a key leaves its earlier files alone; readers see the new history only."""
    lake.run("b1", envelope("b1", "c", 1, 10, V1[0]), envelope("b1", "u", 1, 30, V3[0]), envelope("b1", "c", 2, 11, V1[0]))
    lake.run("b2", envelope("b2", "u", 1, 20, V2[0]), envelope("b2", "u", 2, 21, V2[0]))
    shown = ("id", "_source_lsn", "_record_number", "_record_count", "_is_current")
    assert lake.rows(TYPE2, *shown) == [
        (1, 10, 1, 3, False), (1, 20, 2, 3, False), (1, 30, 3, 3, True), (2, 11, 1, 2, False), (2, 21, 2, 2, True)
    ]
    stored = lake.store._rows(TYPE2)
    assert stored.where("_side = 'closed'").count() == 4 and stored.where("_side = 'tip'").count() == 2


def test_a_key_named_twice_is_refused(lake):
    rows = lake.spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id long, v string")
    with pytest.raises(Exception, match="several source rows for the key"):
        lake.store.upsert("geo.public_silver.v_type1", rows, ["id"])
    lake.store.upsert("geo.public_silver.v_type1", rows.where("v <> 'b'"), ["id"])
    with pytest.raises(Exception, match="several source rows for the key"):
        lake.store.upsert("geo.public_silver.v_type1", rows, ["id"])
    assert lake.store.read("geo.public_silver.v_type1").count() == 2


def test_a_load_of_the_same_name_replaces_itself(lake):
    day = datetime(2026, 5, 31, 12)
    path = write_lines(str(lake.folder / f"{SOURCE}-2026-05-31_02-51-21-000-000001.jsonl"), [envelope("b", "c", k, k, V1[0]) for k in range(9)])
    for _ in range(2):
        ingest_bronze(lake.spark, lake.store, path, SOURCE, lake.ledger, load="one", loaded_at=day)
    assert lake.store.read(BRONZE).count() == 9
    assert [(r.rows, tuple(r.day), r.applied) for r in lake.ledger.loads_of_buffers(BRONZE, TYPE2, ["b"])] == [(9, (2026, 5, 31), False)]
    assert not {"_load", "_bucket", "_raw_file"} & set(lake.store.read(BRONZE).columns)


def test_a_widened_key_stays_in_its_bucket(lake):
    fqn, rows = "geo.public_silver.w_type1", lake.spark.range(40).selectExpr("cast(id AS int) AS id", "'old' AS v")
    lake.store.upsert(fqn, rows, ["id"])
    wide = rows.selectExpr("cast(id AS bigint) AS id", "'new' AS v")
    lake.store.evolve(fqn, plan_evolution(fqn, lake.store.schema(fqn), desired_columns(wide.schema, {}, SILVER)))
    lake.store.upsert(fqn, wide.where("id < 20"), ["id"])
    assert [(r.v, r["count"]) for r in lake.store.read(fqn).groupBy("v").count().orderBy("v").collect()] == [("new", 20), ("old", 20)]


def test_audit_and_schema_versions(lake):
    identity = dict(
        source_instance_name="i", source_database_name="geo", source_schema_name="public",
        source_table_name="scalars", database_name="geo", namespace_name="public_bronze", table_name="scalars",
    )
    lake.load(envelope("buf-1", "u", 1, V1[1], V1[0]))
    lake.apply("buf-1", **identity)
    writes = lake.ledger.read("table_writes").orderBy("write_type").collect()
    assert [(w["write_type"], w["namespace_name"], w["table_name"], w["merge_row_count"]) for w in writes] == [
        ("silver_type_1", "public_silver", "scalars_type1", 1), ("silver_type_2", "public_silver", "scalars_type2", 1)
    ]
    lake.run("buf-2", envelope("buf-2", "u", 1, V2[1], V2[0], extra=42))
    subjects = lake.ledger.read("table_schemas").groupBy("subject").count().collect()
    assert {r["subject"]: r["count"] for r in subjects} == {
        "iceberg.geo.public_bronze.scalars-value": 2,
        "iceberg.geo.public_silver.scalars_type1-value": 2,
        "iceberg.geo.public_silver.scalars_type2-value": 2,
    }
    assert lake.ledger.read("table_writes").count() == 2


def test_text_column_becomes_a_timestamp(lake):
    lake.load(envelope("a", "c", 1, 1, V1[0], seen="2026-05-31T01:00:00.5Z"))
    lake.load(envelope("b", "c", 2, 2, V1[0], seen="junk"))
    document = '{"fields":[{"field":"seen","type":"string","name":"io.debezium.time.ZonedTimestamp"}]}'
    write = lake.load(
        envelope("c", "c", 3, 3, V1[0], seen="2026-05-31T02:00:00.250000Z"),
        envelope("c", "c", 4, 4, V1[0], seen="later"),
        value_schema=document,
    )
    rows = lake.store.read(BRONZE).orderBy("_source_lsn").select(F.col("after_seen").cast("string")).collect()
    assert [r[0] for r in rows] == ["2026-05-31 01:00:00.5", None, "2026-05-31 02:00:00.25", None]
    assert write.lossy == 1
    letters = lake.ledger.read("dead_letters").where("exception_class = 'ValueLost'").collect()
    assert len(letters) == 1 and '"after_seen":"later"' in letters[0]["original_payload"]


def test_columns_only_silver_has_survive_a_rebuild(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]), envelope("buf-1", "u", 2, V1[1], V1[0]))
    silver = lake.store.tips(TYPE2).withColumn("note", F.concat(F.lit("n"), F.col("id").cast("string")))
    wanted = desired_columns(silver.drop("_generation").schema, {}, SILVER)
    lake.store.evolve(TYPE2, plan_evolution(TYPE2, lake.store.schema(TYPE2), wanted))
    lake.store.write_history(TYPE2, silver, SPEC.keys, "notes")
    lake.run("buf-2", envelope("buf-2", "u", 1, V2[1], V2[0]))
    assert lake.rows(TYPE2, "id", "note") == [(1, "n1"), (1, None), (2, "n2")]
    lake.load(envelope("buf-3", "u", 1, V1[1], V1[0]), envelope("buf-3", "u", 2, V1[1], V1[0]))
    assert lake.apply("buf-3").rebuilt
    assert lake.rows(TYPE2, "id", "note") == [(1, "n1"), (1, None), (2, "n2")]


def test_older_silver_layout_is_brought_up_to_date(lake):
    lake.run("buf-1", envelope("buf-1", "u", 1, V1[1], V1[0]), envelope("buf-1", "u", 2, V1[1], V1[0]))
    new = {"_is_deleted", "version_key", "_last_lsn"}
    old = lake.store.tips(TYPE2).drop(*new)
    lake.store = FolderStore(lake.spark, str(lake.folder / "older"), buckets=4)
    lake.load(envelope("buf-1", "u", 1, V1[1], V1[0]), envelope("buf-1", "u", 2, V1[1], V1[0]))
    lake.store.write_history(TYPE2, old, SPEC.keys, "older")
    assert not new & set(lake.store.read(TYPE2).columns)
    lake.run("buf-2", envelope("buf-2", "u", 1, V2[1], V2[0]))
    assert new <= set(lake.store.read(TYPE2).columns)
    assert lake.rows(TYPE2, "id", "_is_deleted", "_is_current") == [
        (1, False, False), (1, False, True), (2, False, True)
    ]
    assert lake.store.read(TYPE2).where("version_key IS NULL").isEmpty()
    lake.run("buf-7", envelope("buf-7", "u", 2, V3[1], V3[0]))
    assert lake.rows(TYPE2, "id", "_is_deleted", "_record_number")[-2:] == [(2, False, 1), (2, False, 2)]


def test_reading_by_the_declared_schema_alone(lake):
    document = (
        '{"fields":[{"field":"id","type":"int64"},{"field":"name","type":"string"},'
        '{"field":"updated_at","type":"string","name":"io.debezium.time.ZonedTimestamp"}]}'
    )
    lines = [envelope("buf-1", "c", 1, 1, V1[0]), envelope("buf-1", "d", 1, 2)]
    lake.load(*lines, schema=envelope_schema(row_schema(document)), value_schema=document)
    columns = lake.store.read(BRONZE).columns
    assert {"before_name", "after_updated_at", "_source_lsn"} <= set(columns) and "after_value" not in columns
    lake.apply("buf-1")
    assert lake.rows(TYPE2, "id", "name", "_valid_from", "_is_deleted") == [
        (1, "one", "2026-05-31 02:27:24.24287", True)
    ]


def test_text_becomes_a_timestamp_without_rewriting_a_file(lake):
    store, fqn = lake.store, "geo.public_silver.texts_type1"
    rows = lake.spark.range(100).selectExpr("id", "'2026-05-31 01:00:00' AS at", "id % 7 AS n")
    store.upsert(fqn, rows, ["id"])
    files = sorted(p.name for p in (lake.folder / "lake").rglob("part-*.parquet") if "_tables" not in str(p))
    stamped = rows.withColumn("at", F.col("at").cast("timestamp"))
    store.evolve(fqn, plan_evolution(fqn, store.schema(fqn), desired_columns(stamped.schema, {}, SILVER)))
    assert sorted(p.name for p in (lake.folder / "lake").rglob("part-*.parquet") if "_tables" not in str(p)) == files
    assert dict(store.read(fqn).dtypes)["at"] == "timestamp"
    again = FolderStore(lake.spark, store.root, buckets=4)
    again.upsert(fqn, lake.spark.createDataFrame([(1, datetime(2026, 6, 1), 1)], "id long, at timestamp, n long"), ["id"])
    seen = again.read(fqn).groupBy(F.col("at").cast("string").alias("at")).count().orderBy("at").collect()
    assert [tuple(r) for r in seen] == [("2026-05-31 01:00:00", 99), ("2026-06-01 00:00:00", 1)]
