"""Notification, dead-letter and audit records: schemas, and readers of the two notification streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import first_present, present
from tidemark.sources.fields import record

# Field names and order of the published records.
FILE_FLUSH = record(
    "write_type string, raw_file_path string, table_name string, extract_job_id string, extract_buffer_id string, "
    "extract_type string, extract_start_at timestamp, extract_end_at timestamp, write_row_count bigint, "
    "raw_file_size bigint, source_instance_name string, source_database_name string, source_schema_name string, "
    "source_table_name string, warehouse_path string, key_schema string, value_schema string, key_schema_id string, "
    "value_schema_id string, source_min_lsn bigint, source_max_lsn bigint"
)
TABLE_UPDATED = record(
    "write_type string, table_fqn string, table_path string, format string, catalog_name string, "
    "database_name string, namespace_name string, table_name string, warehouse_path string, "
    "source_instance_name string, source_database_name string, source_schema_name string, source_table_name string, "
    "raw_file_path string, raw_file_size bigint, extract_job_id string, extract_buffer_id string, "
    "extract_type string, extract_start_at timestamp, extract_end_at timestamp, key_schema string, "
    "value_schema string, key_schema_id string, value_schema_id string, source_min_lsn bigint, source_max_lsn bigint"
)
# As sent here: with the day whose partition took the rows, and their number.
TABLE_LOADED = T.StructType([*TABLE_UPDATED.fields, *record("load_date date, write_row_count bigint").fields])
DEAD_LETTER = record(
    "original_topic string, original_partition int, original_offset bigint, failed_at timestamp, "
    "exception_class string, exception_message string, exception_stack_trace string, extract_job_id string, "
    "extract_buffer_id string, table_identity string, original_payload string"
)
TABLE_WRITE = record(
    "write_type string, catalog_name string, namespace_name string, database_name string, table_name string, "
    "source_instance_name string, source_database_name string, source_schema_name string, source_table_name string, "
    "kafka_topic string, kafka_partition int, kafka_offset bigint, write_row_count bigint, merge_row_count bigint, "
    "raw_file_path string, raw_file_size bigint, extract_job_id string, extract_buffer_id string, "
    "extract_type string, extract_start_at timestamp, extract_end_at timestamp, merge_start_at timestamp, "
    "merge_end_at timestamp, warehouse_path string, key_schema string, value_schema string, key_schema_id string, "
    "value_schema_id string, source_min_lsn bigint, source_max_lsn bigint"
)
TABLE_SCHEMA = record(
    "subject string, version int, schema_json string, wrapped_json string, schema_id string, registered_at timestamp"
)
RUN_METRIC = record(
    "operation string, table_identity string, extract_buffer_id string, outcome string, rows bigint, "
    "started_at timestamp, ended_at timestamp"
)
# One row for each step of a load: for each notified file when it begins, for each raw file and buffer when its rows are in the
# table, for each load when it is announced, for each load and buffer when silver has it.
TABLE_LOAD = record(
    "table_fqn string, load string, state string, loaded_at timestamp, raw_file_path string, extract_buffer_id string, "
    "buckets array<int>, row_count bigint, source_min_lsn bigint, source_max_lsn bigint, recorded_at timestamp"
)
BEGUN, LOADED, ANNOUNCED, APPLIED, ABANDONED = "begun", "loaded", "announced", "applied", "abandoned"
WAITING_FILE = record("raw_file_path string, message string, first_seen timestamp, waiting int, recorded_at timestamp")
JSON_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Kinds of writes and topics.
BRONZE_WRITE = "bronze"
TYPE1_WRITE = "silver_type_1"
TYPE2_WRITE = "silver_type_2"
FLUSH_TOPIC = "cdc-file-write"
UPDATED_TOPIC = "open-table-write-notifications"


def parse_messages(values: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text → the record's columns plus the text itself.

    Missing values are skipped. ``_parsed`` is false where the text is not such a record.
    """
    text = F.col(value).cast("string")
    probe = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = F.from_json(text, probe, {"columnNameOfCorruptRecord": "_corrupt"})
    rest = [c for c in values.columns if c != value]
    return (
        values.where(F.col(value).isNotNull())
        .select(*rest, text.alias("_payload"), parsed.alias("_record"))
        .select(*rest, "_payload", F.col("_record._corrupt").isNull().alias("_parsed"),
                *(F.col(f"_record.{f.name}").alias(f.name) for f in schema.fields))
    )


def file_messages(spark: SparkSession, directory: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Stream of notifications written as JSON lines into a directory; a few hundred bytes each."""
    location = spark._jvm.org.apache.hadoop.fs.Path(directory)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(location)
    lines = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .text(directory)
        .select(F.nullif(F.trim("value"), F.lit("")).alias("value"))
    )
    return parse_messages(lines, schema)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, records_per_batch: int = 10_000
) -> DataFrame:
    """Stream of notifications from a topic, from its start; needs the Kafka source on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", records_per_batch)
        .load()
        .select("value", "partition", "offset")
    )
    return parse_messages(records, schema)


def json_text(value: Column) -> Column:
    """JSON with timestamps to the microsecond; by default only milliseconds would be written."""
    return F.to_json(value, {"timestampFormat": JSON_TIMESTAMP, "timestampNTZFormat": JSON_TIMESTAMP_NTZ})


def message_key(buffer_id: Column, table_fqn: Column) -> Column:
    """Key of a table-updated record: its buffer, else its table."""
    return F.when(present(buffer_id), buffer_id).otherwise(table_fqn)


def to_messages(records: DataFrame, table: str = "table_fqn") -> DataFrame:
    """Records as key and JSON text, ready for a topic or a text file. Missing values are left out."""
    return records.select(
        message_key(F.col("extract_buffer_id"), F.col(table)).alias("key"),
        json_text(F.struct("*")).alias("value"),
    )


def source_table_name(df_source: Column, df_table: Column) -> Column:
    return first_present(df_source, df_table)
