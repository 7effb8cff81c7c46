"""Envelope, naming, notification, merge and schema queries."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.connect import connect_fields
from tidemark.functions.naming import (
    bronze_fqn_column,
    first_present,
    identity_columns,
    identity_complete,
    normalized_id,
    silver_from_bronze_column,
    table_fqn_column,
    table_path_column,
)
from tidemark.functions.timestamps import convert_timestamps, with_load_date, with_transformed_at
from tidemark.operators.evolve import SILVER, align, desired_columns, plan_evolution
from tidemark.operators.flatten import after_image, before_image, change_image, deletes, flatten_envelope, upserts
from tidemark.operators.silver import merge_upsert
from tidemark.plans.ledger import dead_letters as dead_letter_rows, wrap_schema
from tidemark.sources.messages import FILE_FLUSH, FLUSH_TOPIC, TABLE_UPDATED, parse_messages, to_messages
from tidemark.sources.raw import envelope_schema
from tidemark.sources.tables import buffer_summary
from tidemark.spec import ScdSpec
from workloads.history import EVENT_CHANGES, event_changes
from workloads.registry import epoch_millis, query, shown, table

SPEC = ScdSpec()
ROW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as change envelopes (columns ``extract`` and ``payload``)."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    op = F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u")
    stamp = F.date_format("ts", ISO)
    image = F.struct(F.col("user_id").alias("id"), kind.alias("name"), "value", stamp.alias("updated_at"))
    millis = epoch_millis(F.col("ts"))
    return events.select(
        F.struct(
            F.lit("job-1").alias("extract_job_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("extract_buffer_id"),
            F.lit("stream").alias("extract_type"),
            stamp.alias("extracted_at"),
        ).alias("extract"),
        F.struct(
            F.when(kind != "signup", image).alias("before"),
            F.when(kind != "error", image).alias("after"),
            F.struct(
                F.lit("shop").alias("db"),
                F.lit("public").alias("schema"),
                F.lit("events").alias("table"),
                F.col("event_id").alias("lsn"),
                millis.alias("ts_ms"),
            ).alias("source"),
            op.alias("op"),
            millis.alias("ts_ms"),
        ).alias("payload"),
    )


def parsed_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through JSON text and the declared read schema."""
    text = event_envelopes(spark, sf_dir).select(F.to_json(F.struct("extract", "payload")).alias("value"))
    return text.select(F.from_json("value", envelope_schema(ROW)).alias("e")).select("e.extract", "e.payload")


FLAT = (
    "before_id", "before_name", "before_value", "before_updated_at", "after_id", "after_name", "after_value",
    "after_updated_at", "_source_db", "_source_lsn", "_op", "_ts_ms", "_extract_job_id", "_extract_buffer_id",
    "_extract_type", "_extracted_at",
)
SQL_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


@query(f"""
SELECT CASE WHEN event_type <> 'signup' THEN user_id END AS before_id,
       CASE WHEN event_type <> 'signup' THEN event_type END AS before_name,
       CASE WHEN event_type <> 'signup' THEN value END AS before_value,
       CASE WHEN event_type <> 'signup' THEN {SQL_ISO} END AS before_updated_at,
       CASE WHEN event_type <> 'error' THEN user_id END AS after_id,
       CASE WHEN event_type <> 'error' THEN event_type END AS after_name,
       CASE WHEN event_type <> 'error' THEN value END AS after_value,
       CASE WHEN event_type <> 'error' THEN {SQL_ISO} END AS after_updated_at,
       'shop' AS _source_db, event_id AS _source_lsn,
       CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS _op,
       epoch_us(ts) // 1000 AS _ts_ms, 'job-1' AS _extract_job_id, strftime(ts, '%Y-%m-%d') AS _extract_buffer_id,
       'stream' AS _extract_type, {SQL_ISO} AS _extracted_at
FROM events
""")
def envelopes_flattened(spark, sf_dir):
    return flatten_envelope(parsed_envelopes(spark, sf_dir)).select(*FLAT)


@query("""
SELECT CAST(NULL AS BIGINT) AS before_id, CAST(NULL AS VARCHAR) AS before_name, user_id AS after_id,
       event_type AS after_name, event_id AS _source_lsn
FROM events WHERE event_type = 'signup'
""")
def null_image_expanded(spark, sf_dir):
    """Inserts only: a reader infers text for the always-null image; it becomes typed nulls."""
    events = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    image = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("name"))
    payload = F.struct(
        F.lit(None).cast("string").alias("before"), image.alias("after"), F.struct(F.col("event_id").alias("lsn")).alias("source")
    )
    return flatten_envelope(events.select(payload.alias("payload")))


@query(f"""
WITH t AS (SELECT event_id, CASE event_type
    WHEN 'error' THEN 'not a time'
    WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    ELSE {SQL_ISO} END AS text FROM events)
SELECT event_id, text, CAST(coalesce(try_strptime(text, '%Y-%m-%dT%H:%M:%S.%fZ'),
       try_strptime(text, '%Y-%m-%dT%H:%M:%SZ')) AS VARCHAR) AS after_updated_at FROM t
""")
def timestamps_converted(spark, sf_dir):
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", "not a time")
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", ISO))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"), text.alias("after_updated_at"))
    return shown(convert_timestamps(rows))


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS _year, CAST(month(ts) AS INTEGER) AS _month,
       CAST(day(ts) AS INTEGER) AS _day FROM events
""")
def load_date_columns(spark, sf_dir):
    return with_load_date(table(spark, sf_dir, "events").select("event_id", "ts"), F.col("ts")).drop("ts")


@query("SELECT event_id, event_type, true AS stamped FROM events")
def transformed_at_stamped(spark, sf_dir):
    """Every row says when it was transformed: after the query began."""
    began = spark.sql("SELECT current_timestamp()").first()[0]
    rows = with_transformed_at(table(spark, sf_dir, "events").select("event_id", "event_type"))
    return rows.select("event_id", "event_type", (F.col("_transformed_at") >= F.lit(began)).alias("stamped"))


FILE_NAMES = """
SELECT event_id, CASE event_type
    WHEN 'error' THEN 'shop.public.' || event_type || '.avro'
    WHEN 'view' THEN 'shop.public.' || event_type || strftime(ts, '-%Y-%m-%d_%H-%M-%S') || '.jsonl'
    ELSE 'shop.public.' || event_type || strftime(ts, '-%Y-%m-%d_%H-%M-%S-%g-') || lpad(CAST(event_id AS VARCHAR), 6, '0')
         || '.jsonl' END AS file_name
FROM events
"""


@query(f"""
WITH f AS ({FILE_NAMES})
SELECT event_id, file_name, coalesce(
  nullif(regexp_extract(file_name, '^(.+)-(\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}-\\d{{2}}-\\d{{2}}-\\d{{3}})-(\\d{{6}})\\.(jsonl|avro)$', 1), ''),
  nullif(regexp_extract(file_name, '^(.+)-(\\d{{4}}-\\d{{2}}-\\d{{2}}_\\d{{2}}-\\d{{2}}-\\d{{2}})\\.(jsonl|avro)$', 1), ''),
  regexp_replace(file_name, '\\.(jsonl|avro)$', '')) AS table_fqn
FROM f
""")
def file_names_routed(spark, sf_dir):
    kind = F.col("event_type")
    stem = F.concat(F.lit("shop.public."), kind)
    sequence = F.lpad(F.col("event_id").cast("string"), 6, "0")
    name = (
        F.when(kind == "error", F.concat(stem, F.lit(".avro")))
        .when(kind == "view", F.concat(stem, F.date_format("ts", "-yyyy-MM-dd_HH-mm-ss"), F.lit(".jsonl")))
        .otherwise(F.concat(stem, F.date_format("ts", "-yyyy-MM-dd_HH-mm-ss-SSS-"), sequence, F.lit(".jsonl")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", name.alias("file_name"), table_fqn_column(name).alias("table_fqn")
    )


@query("""
WITH n AS (SELECT c_custkey, 'shop.' || lower(c_mktsegment) || '.n' || c_nationkey AS fqn, c_name FROM customer),
b AS (SELECT *, split_part(fqn, '.', 1) || '.' || split_part(fqn, '.', 2) || '_bronze.' || split_part(fqn, '.', 3)
      AS bronze FROM n)
SELECT c_custkey, fqn, bronze, '/data/lake/' || replace(bronze, '.', '/') AS path, split_part(bronze, '.', 1) AS database,
       split_part(bronze, '.', 2) AS namespace, split_part(bronze, '.', 3) AS "table", '/data/lake' AS warehouse,
       replace(split_part(bronze, '.', 2), '_bronze', '_silver') AS silver_namespace,
       CASE WHEN c_custkey < 100 THEN 'unknown' ELSE c_name END AS buffer,
       CASE WHEN c_custkey < 100 THEN fqn ELSE c_name END AS first_name, c_custkey >= 100 AS complete
FROM b
""")
def table_names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("shop."), F.lower("c_mktsegment"), F.lit(".n"), F.col("c_nationkey").cast("string")).alias("fqn"),
        F.when(F.col("c_custkey") < 100, "  ").otherwise(F.col("c_name")).alias("name"),
    )
    named = customer.withColumn("bronze", bronze_fqn_column(F.col("fqn")))
    named = named.withColumn("path", table_path_column("/data/lake", F.col("bronze")))
    parts = named.select("*", *(c.alias(n) for n, c in identity_columns(F.col("path")).items()))
    return parts.select(
        "c_custkey", "fqn", "bronze", "path", "database", "namespace", "table", "warehouse",
        silver_from_bronze_column(F.col("namespace")).alias("silver_namespace"),
        normalized_id(F.col("name")).alias("buffer"),
        first_present(F.col("name"), F.col("fqn")).alias("first_name"),
        identity_complete(F.col("database"), F.col("table"), F.col("name")).alias("complete"),
    )


@query(f"WITH {EVENT_CHANGES} SELECT 'delete' AS part, id, _source_lsn FROM e WHERE _op = 'd' "
       "UNION ALL SELECT 'upsert', id, _source_lsn FROM e WHERE _op <> 'd'")
def operation_split(spark, sf_dir):
    changes = event_changes(spark, sf_dir)
    part = lambda df, name: df.select(F.lit(name).alias("part"), "id", "_source_lsn")
    return part(deletes(changes, SPEC), "delete").union(part(upserts(changes, SPEC), "upsert"))


@query("""
SELECT event_id AS _source_lsn, user_id AS id, event_type AS name, value,
       CASE WHEN event_type <> 'error' THEN event_type END AS after_name,
       CASE WHEN event_type <> 'signup' THEN event_type END AS before_name
FROM events
""")
def row_images(spark, sf_dir):
    """The image that counts per change, next to the after and before projections."""
    flat = flatten_envelope(parsed_envelopes(spark, sf_dir))
    keep = flat.withColumns({"after_a": F.col("after_name"), "after_b": F.col("before_name")})
    image = change_image(keep.withColumns({"before_a": F.col("after_a"), "before_b": F.col("after_b")}), SPEC)
    after, before = set(after_image(flat).columns), set(before_image(flat).columns)
    assert {"id", "name", "value"} <= after & before
    return image.select(
        "_source_lsn", "id", "name", "value", F.col("a").alias("after_name"), F.col("b").alias("before_name")
    )


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS extract_buffer_id, count(*) AS write_row_count, min(event_id) AS source_min_lsn,
       max(event_id) AS source_max_lsn FROM events GROUP BY 1
""")
def write_audit(spark, sf_dir):
    summary = buffer_summary(event_changes(spark, sf_dir), SPEC)
    return summary.withColumnRenamed("_extract_buffer_id", "extract_buffer_id")


@query("""
WITH b AS (SELECT strftime(ts, '%Y-%m-%d') AS buffer, event_type, min(event_id) AS lo, max(event_id) AS hi,
                  count(*) AS n, min(ts) AS began FROM events GROUP BY 1, 2)
SELECT buffer AS key, 'shop.public_bronze.' || event_type AS table_fqn, buffer AS extract_buffer_id, lo AS source_min_lsn,
       hi AS source_max_lsn, event_type AS source_table_name, CAST(began AS VARCHAR) AS extract_start_at
FROM b
""")
def notifications_relayed(spark, sf_dir):
    """File-flush records as JSON → parsed → table-updated records as keyed JSON → parsed again."""
    changes = event_changes(spark, sf_dir)
    flushes = changes.groupBy("_extract_buffer_id", "name").agg(
        F.min("_source_lsn").alias("lo"), F.max("_source_lsn").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.min("updated_at").alias("began"),
    )
    known = {
        "table_name": F.concat(F.lit("shop.public."), F.col("name")),
        "extract_buffer_id": F.col("_extract_buffer_id"),
        "write_row_count": F.col("n"),
        "source_min_lsn": F.col("lo"),
        "source_max_lsn": F.col("hi"),
        "source_table_name": F.col("name"),
        "extract_start_at": F.date_format("began", ISO),
    }
    text = flushes.select(F.to_json(F.struct(*(c.alias(n) for n, c in known.items()))).alias("value"))
    parsed = parse_messages(text, FILE_FLUSH)
    updated = parsed.select(
        *(
            (bronze_fqn_column(F.col("table_name")) if f.name == "table_fqn" else F.col(f.name)).alias(f.name)
            if f.name == "table_fqn" or f.name in parsed.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in TABLE_UPDATED.fields
        )
    )
    again = parse_messages(to_messages(updated), TABLE_UPDATED)
    return shown(
        again, "key", "table_fqn", "extract_buffer_id", "source_min_lsn", "source_max_lsn", "source_table_name",
        "extract_start_at",
    )


@query("""
SELECT '{"id":' || event_id || ',"kind":"' || event_type AS original_payload, 'unknown' AS extract_job_id,
       'cdc-file-write' AS original_topic, 'CorruptRecord' AS exception_class, 'shop.public.events' AS table_identity
FROM events WHERE event_type = 'error'
""")
def dead_letters(spark, sf_dir):
    """Damaged JSON lines are kept whole, with why and where from."""
    kind = F.col("event_type")
    line = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(',"kind":"'), kind)
    lines = table(spark, sf_dir, "events").select(
        F.when(kind == "error", line).otherwise(F.concat(line, F.lit('"}'))).alias("line")
    )
    schema = "id bigint, kind string, _bad string"
    parsed = lines.withColumn("e", F.from_json("line", schema, {"columnNameOfCorruptRecord": "_bad"}))
    broken = parsed.where(F.col("e._bad").isNotNull())
    letters = dead_letter_rows(
        broken, "line", FLUSH_TOPIC, "CorruptRecord", F.lit("not an envelope"), "shop.public.events"
    )
    return letters.select(
        "original_payload", "extract_job_id", "original_topic", "exception_class", "table_identity"
    )


@query("""
WITH s AS (SELECT c_custkey, c_name || ' II' AS c_name, c_acctbal + 100 AS c_acctbal FROM customer WHERE c_nationkey < 5
           UNION ALL SELECT c_custkey + 1000000000, c_name, c_acctbal FROM customer WHERE c_nationkey = 7)
SELECT coalesce(s.c_custkey, c.c_custkey) AS c_custkey, CASE WHEN s.c_custkey IS NULL THEN c.c_name ELSE s.c_name END AS c_name,
       CASE WHEN s.c_custkey IS NULL THEN c.c_acctbal ELSE s.c_acctbal END AS c_acctbal, c.c_mktsegment AS c_mktsegment
FROM customer c FULL JOIN s ON c.c_custkey = s.c_custkey
""")
def merged_by_key(spark, sf_dir):
    """Matched rows take incoming columns and keep the others; unmatched rows are added."""
    customer = table(spark, sf_dir, "customer")
    changed = customer.where(F.col("c_nationkey") < 5).select(
        "c_custkey", F.concat("c_name", F.lit(" II")).alias("c_name"), (F.col("c_acctbal") + 100).alias("c_acctbal")
    )
    added = customer.where(F.col("c_nationkey") == 7).select(
        (F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name", "c_acctbal"
    )
    target = customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return merge_upsert(target, changed.unionByName(added), ["c_custkey"])


@query("""
SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS p_type,
       CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS p_retailprice, p_brand FROM part
""")
def schema_aligned(spark, sf_dir):
    """Incoming rows without one column, with narrower types and a new column, as the table has them."""
    stored = T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_size", T.LongType()),
            T.StructField("p_type", T.StringType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    )
    incoming = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", F.col("p_retailprice").cast("float").alias("p_retailprice"), "p_size"
    )
    desired = desired_columns(incoming.schema, {}, SILVER)
    return align(incoming, desired, plan_evolution("parts", stored, desired).schema)


@query("""
SELECT CAST(o_orderkey AS BIGINT) AS k, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS DOUBLE) AS amount, CAST(o_orderdate AS VARCHAR) AS placed_at
FROM orders
""")
def schema_widened(spark, sf_dir):
    """A table of narrow types after it was widened for new data: int, float, decimal, text to timestamp."""
    old = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("k"),
        F.col("o_totalprice").cast("float").alias("price"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.date_format("o_orderdate", ISO).alias("placed_at"),
    )
    wanted = T.StructType(
        [
            T.StructField("k", T.LongType()),
            T.StructField("price", T.DoubleType()),
            T.StructField("amount", T.DecimalType(18, 4)),
            T.StructField("placed_at", T.TimestampType()),
        ]
    )
    evolution = plan_evolution("orders", old.schema, desired_columns(wanted, {}, SILVER))
    rows = align(old, desired_columns(old.schema, {}, SILVER), evolution.schema)
    return shown(rows.withColumn("amount", F.col("amount").cast("double")))


DOCUMENT = json.dumps(
    {
        "type": "struct",
        "fields": [
            {
                "field": "after",
                "type": "struct",
                "fields": [
                    {"field": "k", "type": "int64"},
                    {"field": "size", "type": "int32"},
                    {
                        "field": "price",
                        "type": "bytes",
                        "name": "org.apache.kafka.connect.data.Decimal",
                        "parameters": {"scale": "2", "connect.decimal.precision": "12"},
                    },
                    {"field": "made_at", "type": "int64", "name": "io.debezium.time.MicroTimestamp"},
                    {"field": "sold_at", "type": "string", "name": "io.debezium.time.ZonedTimestamp"},
                    {"field": "status", "type": "string", "default": "active"},
                ],
            }
        ],
    }
)


@query("""
SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS size,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price, CAST(o_orderdate AS VARCHAR) AS made_at,
       CAST(o_orderdate AS VARCHAR) AS sold_at, CAST(NULL AS VARCHAR) AS status
FROM orders
""")
def declared_schema(spark, sf_dir):
    """Rows of loose types brought to what a Connect document declares; text that is no number becomes null."""
    loose = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("int").alias("k"),
        F.when(F.col("o_orderstatus") == "P", "none").otherwise(F.col("o_custkey").cast("string")).alias("size"),
        F.format_string("%.2f", "o_totalprice").alias("price"),
        (epoch_millis(F.col("o_orderdate")) * 1000).alias("made_at"),
        F.date_format("o_orderdate", ISO).alias("sold_at"),
    )
    rows = align(loose, desired_columns(loose.schema, connect_fields(DOCUMENT), SILVER))
    return shown(rows.withColumn("price", F.col("price").cast("double")))


@query("""
SELECT c_custkey, 'iceberg.shop.' || lower(c_mktsegment) || '_bronze.n' || c_nationkey || '-value' AS subject, 2 AS fields FROM customer
""")
def schema_subjects(spark, sf_dir):
    """Subject and wrapped schema of the table that each row names."""
    wrapped = wrap_schema(T.StructType().add("id", T.LongType()).add("name", T.StringType()).json())
    names = table(spark, sf_dir, "customer")
    space = F.concat(F.lower("c_mktsegment"), F.lit("_bronze"))
    subject = F.concat_ws(".", F.lit("iceberg.shop"), space, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"), F.lit("-value")))
    fields = F.size(F.from_json(F.get_json_object(F.lit(wrapped), "$.x-spark-schema.fields"), "array<string>"))
    return names.select("c_custkey", subject.alias("subject"), fields.alias("fields"))


IMAGE = "SELECT event_id AS _source_lsn, {id} AS id, {name} AS name, {value} AS value, {stamp} AS updated_at FROM events"


def _image_sql(there: str) -> str:
    parts = {"id": "user_id", "name": "event_type", "value": "value", "stamp": SQL_ISO}
    return IMAGE.format(**{k: f"CASE WHEN {there} THEN {v} END" for k, v in parts.items()})


@query(_image_sql("event_type <> 'error'"))
def after_images(spark, sf_dir):
    return after_image(flatten_envelope(parsed_envelopes(spark, sf_dir))).select("_source_lsn", "id", "name", "value", "updated_at")


@query(_image_sql("event_type <> 'signup'"))
def before_images(spark, sf_dir):
    return before_image(flatten_envelope(parsed_envelopes(spark, sf_dir))).select("_source_lsn", "id", "name", "value", "updated_at")


@query("""
SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS part, user_id AS id, event_id AS _source_lsn,
       CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN NULL ELSE 'u' END AS _op FROM events
""")
def null_operations(spark, sf_dir):
    """A change without an operation code is an upsert."""
    changes = event_changes(spark, sf_dir).withColumn("_op", F.when(F.col("_op") != "c", F.col("_op")))
    part = lambda df, name: df.select(F.lit(name).alias("part"), "id", "_source_lsn", "_op")
    return part(deletes(changes, SPEC), "delete").union(part(upserts(changes, SPEC), "upsert"))
