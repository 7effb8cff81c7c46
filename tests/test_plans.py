"""Plans that must stay as they are: exchanges, sorts, pushed filters, pruned partitions and columns."""

import re

from pyspark.sql import functions as F

from tests.envelopes import V1, envelope
from tests.test_tables import BRONZE, SPEC, TYPE2, lake  # noqa: F401 - fixture
from tidemark.functions.timestamps import convert_timestamps
from tidemark.operators.silver import as_of, derive_type1, merge_upsert, type1_of_complete
from tidemark.operators.versions import build_type2
from tidemark.sources.tables import buffer_rows
from workloads.history import event_changes
from workloads.records import parsed_envelopes
from tidemark.operators.flatten import change_image, flatten_envelope

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"(?<![A-Za-z]){operator} ", text))


def test_history_needs_one_exchange_and_one_sort(spark):
    text = plan(build_type2(event_changes(spark, SF), SPEC))
    assert count(text, "Exchange") == 1 and count(text, "Sort") == 1
    assert count(text, "Window") == 5
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "props" not in text


def test_reads_of_a_history_do_not_shuffle(spark):
    history = spark.createDataFrame([], build_type2(event_changes(spark, SF), SPEC).schema)
    for df in (type1_of_complete(history), as_of(history, "2024-01-15 00:00:00")):
        assert count(plan(df), "Exchange") == 0
    text = plan(derive_type1(history, SPEC))
    assert count(text, "Exchange") == 1 and "WindowGroupLimit" in text


def test_flattening_is_one_projection(spark):
    text = plan(convert_timestamps(change_image(flatten_envelope(parsed_envelopes(spark, SF)), SPEC)))
    assert count(text, "Exchange") == 0 and text.count("FileScan parquet") == 1


def test_merge_shuffles_each_side_once(spark):
    customer = spark.read.parquet(f"{SF}/customer.parquet")
    changed = customer.select("c_custkey", F.lit("x").alias("c_name"))
    assert count(plan(merge_upsert(customer, changed, ["c_custkey"])), "Exchange") <= 2


def test_table_reads_are_pruned(lake):  # noqa: F811
    lake.run("buf-1", *(envelope("buf-1", "c", k, k, V1[0]) for k in range(20)))
    buffers = plan(buffer_rows(lake.store.read(BRONZE), ["buf-1"], [(2026, 5, 31)]).select("after_id"))
    assert re.search(r"PushedFilters: \[[^\]]*_extract_buffer_id", buffers)
    assert re.search(r"PartitionFilters: \[[^\]]*_year", buffers)
    assert re.search(r"ReadSchema: struct<after_id:bigint,_extract_buffer_id:string>", buffers)
    silver = plan(lake.store.read(TYPE2, [1]).select("id"))
    assert re.search(r"PartitionFilters: \[[^\]]*_bucket", silver)
    assert "ReadSchema: struct<id:bigint>" in silver


def test_late_keys_read_the_partitions_of_their_buckets_and_days(lake, monkeypatch):  # noqa: F811
    lake.run("buf-1", *(envelope("buf-1", "c", k, 100 + k, V1[0]) for k in range(20)))
    lake.spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(lake.store.read_log(BRONZE, [(2026, 5, 31)], None, [1, 2]).select("after_id"))
    lake.spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", text)[1]
    assert "_bucket" in filters and "_year" in filters and "_load" in filters
    # A late key's bucket and days are all that is asked for.
    lake.load(envelope("buf-0", "c", 3, 50, V1[0]))
    asked, read = [], lake.store.read_log
    monkeypatch.setattr(lake.store, "read_log", lambda *a: asked.append(a) or read(*a))
    assert lake.apply("buf-0").rebuilt
    (_, days, loads, *_), (_, late_days, _, buckets) = asked
    assert len(days) == len(loads) == len(late_days) == len(buckets) == 1
    # A replay reads neither bronze nor silver.
    monkeypatch.setattr(lake.store, "read_log", None)
    monkeypatch.setattr(lake.store, "tips", None)
    assert lake.apply("buf-1").type2_rows == lake.apply("buf-0").type2_rows == 0


def test_an_increment_reads_last_versions_only(lake):  # noqa: F811
    lake.run("buf-1", *(envelope("buf-1", "c", k, 100 + k, V1[0]) for k in range(20)))
    text = plan(lake.store.tips(TYPE2, [1]).select("id"))
    assert re.search(r"PartitionFilters: \[[^\]]*_side[^\]]* = tip", text) and re.search(r"PartitionFilters: \[[^\]]*_bucket", text)
