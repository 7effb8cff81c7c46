"""Raw change files: JSON lines, and Avro where the Spark package is on the class path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.functions.naming import table_fqn_column
from tidemark.sources.fields import record

JSON_EXTENSIONS = (".jsonl", ".json")
AVRO_EXTENSION = ".avro"
CORRUPT = "_corrupt_record"

# Fields of the change envelope besides the row images.
SOURCE_FIELDS = record(
    "version string, connector string, name string, ts_ms bigint, snapshot string, db string, sequence string, "
    "ts_us bigint, ts_ns bigint, schema string, table string, txId bigint, lsn bigint, xmin bigint"
)
EXTRACT_FIELDS = record(
    "extract_job_id string, extract_buffer_id string, extract_type string, extracted_at string"
)
EVENT_FIELDS = record("transaction string, op string, ts_ms bigint, ts_us bigint, ts_ns bigint")


def envelope_schema(row: T.StructType) -> T.StructType:
    """Declared read schema of an envelope around a row: no inference pass, images always structs."""
    payload = T.StructType().add("before", row).add("after", row).add("source", SOURCE_FIELDS)
    payload = T.StructType([*payload.fields, *EVENT_FIELDS.fields])
    return T.StructType().add("extract", EXTRACT_FIELDS).add("payload", payload)


def raw_format(paths: Iterable[str]) -> str:
    kinds = set()
    for path in paths:
        name = path.rsplit("/", 1)[-1].lower()
        if name.endswith(JSON_EXTENSIONS):
            kinds.add("json")
        elif name.endswith(AVRO_EXTENSION):
            kinds.add("avro")
        else:
            raise ValueError(f"unsupported raw file extension: {path}; expected .jsonl, .json or .avro")
    if len(kinds) != 1:
        raise ValueError(f"one read needs files of one format, got {sorted(kinds)}")
    return kinds.pop()


def read_raw(spark: SparkSession, paths: str | Iterable[str], schema: T.StructType | None = None) -> DataFrame:
    """Read any number of raw files as one relation.

    With a schema the read is one pass and lines that do not fit are kept whole in ``_corrupt_record``;
    without one, Spark infers it. A missing file is an error.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if raw_format(paths) == "avro":
        try:
            return spark.read.format("avro").load(paths)
        except AnalysisException as error:
            if "avro" in str(error).lower():
                raise RuntimeError("reading .avro files needs the spark-avro package on the class path") from error
            raise
    reader = spark.read
    if schema is not None:
        if CORRUPT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(paths)


def inferred_envelope(spark: SparkSession, paths: Iterable[str]) -> T.StructType:
    """Schema of JSON-lines files by inference, with a column for lines that are not JSON."""
    inferred = spark.read.json(list(paths)).schema
    return T.StructType([f for f in inferred.fields if f.name != CORRUPT])


def with_source_table(raw: DataFrame, file_name: Column | None = None) -> DataFrame:
    """Route rows of a whole directory by the file they came from."""
    file_name = F.col("_metadata.file_name") if file_name is None else file_name
    return raw.select("*", file_name.alias("_file_name"), table_fqn_column(file_name).alias("_source_fqn"))
