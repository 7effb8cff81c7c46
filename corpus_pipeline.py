"""From raw documents to token ids: a chain of stages, each written as Parquet and read again by the next.

What a stage writes on the way to its decisions is removed before it returns; only what its result is read from stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import language, mixing, queries
from tidemark.llm.common import sized
from tidemark.llm.decontaminate import contaminated
from tidemark.llm.jaccard import similar_documents
from tidemark.llm.token_ids import encoded_documents
from tidemark.operators.scratch import scratch_scope, settled, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: A document that is less likely than this to be in one of the labelled languages, whichever, is rejected, as is one without letters.
LEAST_KNOWN = 0.5
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows with a written number ``_row``: decisions are about rows, as ids may be null or repeated."""
    return written(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()))


def _without(rows: DataFrame, gone: DataFrame, by: str) -> DataFrame:
    return rows.join(sized(gone), by, "left_anti").select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts in no known language."""
    told = language.predict(docs.select(*COLUMNS), language.train(docs, strange=True))
    return told.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("known") >= LEAST_KNOWN)).select(*COLUMNS)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones stays: that with the smallest id (of repeated ids, one row; null ids last)."""
    rows = _numbered(docs)

    def gone() -> DataFrame:
        found = similar_documents(rows.select(F.col("_row").alias("doc_id"), "text"))
        found = written(found.select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")))
        several = written(found.filter("_row <> group").select("group").distinct())
        member = written(found.join(sized(several), "group", "left_semi").join(rows.select("_row", "doc_id"), "_row"))
        order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "_row")
        first = written(member.groupBy("group").agg(F.min(order)["_row"].alias("first")))
        return member.join(sized(first), "group").filter("_row <> first").select("_row")

    return _without(rows, settled(spark, gone), "_row")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat a benchmark item go. That is told by the text alone, so rows are known by a hash of it and need no copy."""
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("_hash"))

    def gone() -> DataFrame:
        found = contaminated(rows.select(F.col("_hash").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
        return found.select(F.col("doc_id").alias("_hash")).distinct()

    return _without(rows, settled(spark, gone), "_hash")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    with scratch_scope(spark):  # the model is numbers of the driver
        model = mixing.fit_rates(docs, mixing.learn_domains(docs, labels))
    return mixing.with_rates(docs.select(*COLUMNS), model).select(*COLUMNS, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed ids of what is left, read back from the files."""
    return encoded_documents(docs, queries.vocabulary_file(), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]
#: No SQL can express the network of the first stage; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    def after(stages: list[tuple[str, Stage]]) -> DataFrame:
        """The last of ``stages``, written; what the stages before have written goes."""
        if not stages:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        *before, (_, stage) = stages
        return settled(spark, lambda: stage(spark, after(before), sf_dir))

    return after(STAGES)
