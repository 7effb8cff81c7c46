"""Flattening, naming, schema documents, evolution, single change steps."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.envelopes import V1, envelope, write_lines
from tests.walk import SCHEMA
from tidemark.functions import naming
from tidemark.functions.connect import connect_fields, row_schema
from tidemark.functions.keys import utc_text
from tidemark.functions.timestamps import convert_timestamps
from tidemark.operators.changes import changed_upserts, close_deleted, lineage_refresh, tombstones
from tidemark.operators.evolve import (
    BRONZE,
    SILVER,
    SchemaIncompatibleError,
    align,
    default_sql,
    desired_columns,
    lossy,
    plan_evolution,
    safe_coercion,
)
from tidemark.operators.flatten import flatten_envelope
from tidemark.operators.silver import as_of, merge_upsert
from tidemark.operators.skew import find_hot_keys, with_ordinals
from tidemark.operators.versions import build_type2
from tidemark.plans.ledger import Ledger, wrap_schema, write_complete
from tidemark.sources.messages import FILE_FLUSH, TABLE_UPDATED, parse_messages, to_messages
from tidemark.sources.raw import CORRUPT, envelope_schema, read_raw
from tidemark.spec import ScdSpec

SPEC = ScdSpec()
ddl = T._parse_datatype_string


def test_file_names():
    route = naming.table_fqn_from_file_name
    assert route("geo.public.scalars-2026-06-07_20-07-52-983-000001.jsonl") == "geo.public.scalars"
    assert route("geo.public.scalars-2026-06-07_20-07-52-983-000001.avro") == "geo.public.scalars"
    assert route("geo.public.scalars-2026-05-31_02-51-21.jsonl") == "geo.public.scalars"
    assert route("custom.table.jsonl") == "custom.table"
    assert route("custom.table.avro") == "custom.table"


def test_names():
    assert naming.bronze_fqn("geo.public.scalars") == "geo.public_bronze.scalars"
    with pytest.raises(ValueError):
        naming.bronze_fqn("public.scalars")
    assert naming.silver_from_bronze("public_bronze") == "public_silver"
    assert naming.silver_from_bronze("other") == "other"
    assert naming.silver_fqn("geo.public_bronze.scalars", "_type2") == "geo.public_silver.scalars_type2"
    assert naming.value_subject("geo", "public_bronze", "scalars") == "iceberg.geo.public_bronze.scalars-value"
    assert naming.identity_from_path("/opt/lake/geo/public_bronze/scalars") == {
        "database": "geo", "namespace": "public_bronze", "table": "scalars", "warehouse": "/opt/lake"
    }
    with pytest.raises(ValueError):
        naming.identity_from_path("/a/b")


def test_raw_reading(spark, tmp_path):
    path = write_lines(str(tmp_path / "t.JSONL"), [envelope("b", "c", 1, 1, V1[0]), "{broken"])
    row = ddl("id bigint, updated_at string")
    rows = read_raw(spark, path, envelope_schema(row))
    assert rows.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "payload").first()[0] == "{broken"
    with pytest.raises(ValueError, match="unsupported"):
        read_raw(spark, "a.csv")
    with pytest.raises(RuntimeError, match="spark-avro"):
        read_raw(spark, str(tmp_path / "x.avro"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_raw(spark, str(tmp_path / "none.jsonl"))


def test_flatten_null_images_and_optional_parts(spark, tmp_path):
    create = write_lines(str(tmp_path / "c.jsonl"), [envelope("b", "c", 1, 1, V1[0])])
    flat = flatten_envelope(read_raw(spark, create))
    assert flat.schema["before_id"].dataType == T.LongType()
    row = flat.first()
    assert (row["before_id"], row["after_id"], row["_op"], row["_source_lsn"]) == (None, 1, "c", 1)
    assert row["_extract_buffer_id"] == "b" and "_extracted_at" in flat.columns
    delete = write_lines(str(tmp_path / "d.jsonl"), [envelope("b", "d", 1, 1)])
    row = flatten_envelope(read_raw(spark, delete)).first()
    assert (row["before_id"], row["after_id"]) == (1, None)
    bare = write_lines(
        str(tmp_path / "b.jsonl"), [{"payload": {"after": {"id": 1}, "source": "text", "op": "c", "other": 1}}]
    )
    assert flatten_envelope(read_raw(spark, bare)).columns == ["after_id", "_op"]


def test_timestamps(spark):
    rows = spark.createDataFrame(
        [("2026-05-31T02:27:24.242870Z",), ("2026-05-31T02:27:24Z",), ("2026-05-31 02:27",), (None,)],
        "after_updated_at string",
    )
    out = convert_timestamps(rows)
    assert out.schema[0].dataType == T.TimestampType()
    texts = [r[0] for r in out.select(F.col("after_updated_at").cast("string")).collect()]
    assert texts == ["2026-05-31 02:27:24.24287", "2026-05-31 02:27:24", None, None]


def test_version_text_does_not_depend_on_the_session_zone(spark):
    rows = spark.createDataFrame([(1_780_194_444_242_870,)], "us bigint").select(F.timestamp_micros("us").alias("t"))
    text = rows.select(utc_text(F.col("t"), T.TimestampType()))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert text.first()[0] == "2026-05-31 02:27:24.24287"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_connect_documents():
    document = json.dumps(
        {
            "type": "struct",
            "fields": [
                {"field": "before", "type": "struct", "fields": [{"field": "old", "type": "int32"}]},
                {
                    "field": "after",
                    "type": "struct",
                    "fields": [
                        {"field": "id", "type": "int32"},
                        {"field": "status", "type": "string", "default": "active"},
                        {"field": "amount", "type": "bytes", "name": "org.apache.kafka.connect.data.Decimal",
                         "parameters": {"scale": "2", "connect.decimal.precision": "12"}},
                        {"field": "wide", "type": "bytes", "name": "x.Decimal"},
                        {"field": "at", "type": "string", "name": "io.debezium.time.ZonedTimestamp"},
                        {"field": "micros", "type": "int64", "name": "io.debezium.time.MicroTimestamp"},
                        {"field": "day", "type": "string", "name": "x.Date"},
                        {"field": "list", "type": "array"},
                        {"field": "untyped"},
                        {"field": " "},
                    ],
                },
            ],
        }
    )
    fields = connect_fields(document)
    assert {n: f.data_type.simpleString() for n, f in fields.items()} == {
        "id": "int", "status": "string", "amount": "decimal(12,2)", "wide": "decimal(38,10)", "at": "timestamp",
        "micros": "timestamp", "day": "date", "list": "string", "untyped": "string",
    }
    assert fields["status"].default == "active" and fields["micros"].unit == "micros"
    assert row_schema(document)["micros"].dataType == T.LongType()
    only_before = '{"fields":[{"field":"before","type":"struct","fields":[{"field":"a","type":"int8"}]}]}'
    assert list(connect_fields(only_before)) == ["a"]
    assert list(connect_fields('{"fields":[{"field":"x","type":"boolean"}]}')) == ["x"]
    assert connect_fields(None) == connect_fields("  ") == connect_fields("{") == connect_fields("[]") == {}


def test_integer_timestamps_are_scaled(spark):
    document = json.dumps({"fields": [
        {"field": "a", "type": "int64", "name": "org.apache.kafka.connect.data.Timestamp"},
        {"field": "b", "type": "int64", "name": "io.debezium.time.MicroTimestamp"},
        {"field": "c", "type": "int64", "name": "io.debezium.time.NanoTimestamp"},
    ]})
    rows = spark.createDataFrame([(1_500, 1_500_000, 1_500_000_000)], "a bigint, b bigint, c bigint")
    out = align(rows, desired_columns(rows.schema, connect_fields(document), SILVER))
    texts = out.select(*(F.col(c).cast("string") for c in "abc")).first()
    assert tuple(texts) == ("1970-01-01 00:00:01.5",) * 3


@pytest.mark.parametrize("current,wanted,safe", [
    ("decimal(10,2)", "decimal(18,4)", True), ("string", "string", True), ("int", "bigint", True),
    ("int", "string", False), ("decimal(18,4)", "decimal(10,2)", False), ("string", "timestamp", True),
    ("timestamp", "string", False), ("timestamp", "timestamp_ntz", True), ("float", "double", True),
    ("decimal(10,2)", "decimal(10,4)", False), ("bigint", "int", False),
])
def test_coercions(spark, current, wanted, safe):
    kind = lambda text: T._parse_datatype_string(f"c {text}")[0].dataType
    assert safe_coercion(kind(current), kind(wanted)) is safe


def test_evolution_plan(spark):
    table = ddl("a int not null, b double, gone string, t string")
    new = ddl("a bigint, b float, n string, t timestamp")
    plan = plan_evolution("x", table, desired_columns(new, {}, SILVER))
    assert (plan.added, plan.widened, plan.rewritten) == (["n"], ["a"], ["t"])
    assert plan.schema.simpleString() == "struct<a:bigint,b:double,gone:string,t:timestamp,n:string>"
    assert all(f.nullable for f in plan.schema.fields)
    with pytest.raises(SchemaIncompatibleError, match="x.a: cannot change int to string"):
        plan_evolution("x", table, desired_columns(ddl("a string"), {}, SILVER))


def test_declared_types_and_parsed_timestamps(spark):
    declared = connect_fields('{"fields":[{"field":"at","type":"string"},{"field":"n","type":"int32","default":3}]}')
    incoming = ddl("before_at timestamp, after_n string")
    desired = desired_columns(incoming, declared, BRONZE)
    kinds = {n: d.data_type.simpleString() for n, d in desired.items()}
    assert kinds == {"before_at": "timestamp", "after_n": "int", "after_at": "string", "before_n": "int"}
    rows = spark.createDataFrame([(None, "7"), (datetime(2026, 1, 1), "x")], incoming)
    assert [r["after_n"] for r in align(rows, desired).collect()] == [7, None]
    assert rows.where(lossy(rows, desired)).count() == 1
    assert lossy(rows, desired_columns(rows.schema, {}, BRONZE)) is None
    assert default_sql("it's", T.StringType()) == "'it\\'s'"
    assert default_sql(True, T.BooleanType()) == "true"
    assert default_sql(7, T.IntegerType()) == "TRY_CAST(7 AS int)"


def test_alignment_of_loosely_inferred_columns(spark):
    rows = spark.createDataFrame([(None, 7, 1)], "before_f string, after_f int, after_id int")
    table = ddl("after_id int, before_f int, after_f int, kept date")
    out = align(rows, desired_columns(rows.schema, {}, BRONZE), table)
    assert out.columns == ["after_id", "before_f", "after_f", "kept"]
    assert tuple(out.first()) == (1, None, 7, None)


def changes(spark, *rows):
    return spark.createDataFrame([(*r, "b", "j") for r in rows], SCHEMA)


DAY = datetime(2026, 1, 1)


def test_single_steps_against_silver(spark):
    silver = build_type2(changes(spark, (1, "a", DAY, "c", 1, 0), (2, "b", None, "c", 2, 0), (3, "c", DAY, "c", 30, 0)), SPEC)
    incoming = changes(spark, (1, "a2", DAY, "r", 5, 0), (2, "b2", None, "u", 6, 0), (4, "d", DAY, "c", 7, 0))
    assert {r["id"] for r in changed_upserts(incoming, silver, SPEC).collect()} == {2, 4}
    assert [(r["id"], r["name"]) for r in lineage_refresh(incoming, silver, SPEC).collect()] == [(1, "a")]
    gone = changes(spark, (1, "x", None, "d", 8, 1_000), (1, "x", None, "d", 9, 2_000), (3, "x", None, "d", 4, 0),
                   (9, "x", None, "d", 10, 0))
    closed = close_deleted(gone, silver, SPEC).collect()
    assert [(r["id"], r["_valid_to"], r["_is_current"], r["_is_deleted"]) for r in closed] == [
        (1, datetime(1970, 1, 1, 0, 0, 2), False, True)
    ]
    assert [r["id"] for r in tombstones(gone, silver, SPEC).collect()] == [9]
    assert sorted(r["id"] for r in tombstones(gone, None, SPEC).collect()) == [1, 3, 9]


def test_point_in_time(spark):
    silver = build_type2(
        changes(spark, (1, "a", datetime(2026, 1, 1), "c", 1, 0), (1, "b", datetime(2026, 1, 3), "u", 2, 0)), SPEC
    )
    assert [r["name"] for r in as_of(silver, "2026-01-02 00:00:00").collect()] == ["a"]
    assert [r["name"] for r in as_of(silver, "2026-01-03 00:00:00").collect()] == ["b"]
    assert as_of(silver, "2025-01-01 00:00:00").isEmpty()


def test_merge_keeps_columns_only_the_target_has(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, own int")
    source = spark.createDataFrame([(2, "B", True), (3, "C", False)], "k int, v string, new boolean")
    rows = sorted(tuple(r) for r in merge_upsert(target, source, ["k"]).collect())
    assert rows == [(1, "a", 10, None), (2, "B", 20, True), (3, "C", None, False)]


@pytest.mark.parametrize("hot_rows", [10**6, 7])
def test_ordinals(spark, hot_rows):
    rows = [(None if i % 3 == 0 else i % 3, i) for i in range(100)] + [(1, i) for i in range(1000, 1200)]
    df = spark.createDataFrame(rows, "k int, o int").repartition(6)
    out = with_ordinals(df, ["k"], "o", ScdSpec(hot_rows=hot_rows)).collect()
    want = {}
    for key in (None, 1, 2):
        ordered = sorted(o for k, o in rows if k == key)
        want.update({(key, o): (n, len(ordered)) for n, o in enumerate(ordered, 1)})
    assert {(r["k"], r["o"]): (r["_record_number"], r["_record_count"]) for r in out} == want


def test_hot_keys_are_found(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    assert find_hot_keys(df, ["k"], ScdSpec(hot_rows=500)).chunks == 3
    assert find_hot_keys(df, ["k"], ScdSpec(hot_rows=1500)) is None
    assert find_hot_keys(df, ["k"], ScdSpec()) is None


def test_chunks_of_hot_keys_stay_small(spark):
    """A threshold that follows the table's size must not make a task's share follow it."""
    df = spark.range(2_000_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    assert find_hot_keys(df, ["k"], ScdSpec(hot_rows=900_000)).chunks == 4
    out = with_ordinals(df, ["k"], "o", ScdSpec(hot_rows=900_000))
    wrong = (F.col("_record_number") != F.expr("o div 2") + 1) | (F.col("_record_count") != 1_000_000)
    assert out.count() == 2_000_000 and out.where(wrong).count() == 0


def test_notifications(spark):
    text = (
        '{"write_type":"raw","raw_file_path":"/d/f.jsonl","extract_buffer_id":" ","source_min_lsn":5,'
        '"extract_start_at":"2026-05-31T02:50:21.544690220Z"}'
    )
    values = spark.createDataFrame([(text,), ("nonsense",), (None,)], "value string")
    rows = parse_messages(values, FILE_FLUSH).orderBy("_parsed").collect()
    assert [r["_parsed"] for r in rows] == [False, True]
    assert (rows[1]["source_min_lsn"], rows[1]["extract_start_at"].microsecond) == (5, 544690)
    assert (len(FILE_FLUSH.fields), len(TABLE_UPDATED.fields)) == (21, 26)
    record = {f.name: None for f in TABLE_UPDATED.fields} | {"table_fqn": "a.b.c", "extract_buffer_id": " "}
    sent = to_messages(spark.createDataFrame([tuple(record.values())], TABLE_UPDATED)).first()
    assert sent["key"] == "a.b.c" and json.loads(sent["value"]) == {"table_fqn": "a.b.c", "extract_buffer_id": " "}


def test_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.read("table_writes").isEmpty()
    schema = ddl("a int").json()
    first = ledger.register_schema("s", schema)
    assert ledger.register_schema("s", schema) == first
    assert ledger.register_schema("s", ddl("b int").json()) != first
    assert ledger.register_schema(" ", schema) is None and ledger.register_schema("s", None) is None
    wrapped = json.loads(wrap_schema(schema))
    assert wrapped["title"] == "spark-table-schema" and wrapped["x-spark-schema"]["type"] == "struct"
    assert not write_complete({"write_type": "bronze"})
    with pytest.raises(KeyError):
        with ledger.observed("step", "t", "b"):
            raise KeyError("x")
    metric = ledger.read("run_metrics").first()
    assert (metric["operation"], metric["outcome"], metric["extract_buffer_id"]) == ("step.records", "error", "b")
