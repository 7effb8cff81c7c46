"""The two streams over folders of notifications."""

import json
from datetime import date

import pytest

from tests.envelopes import V1, V2, envelope, write_lines
from tidemark.plans.ledger import Ledger
from tidemark.plans.silver import transform_buffers
from tidemark.plans.store import FolderStore
from tidemark.sources.messages import FILE_FLUSH, parse_messages
from tidemark.spec import ScdSpec
from tidemark.streaming.jobs import bronze_batch, named_by, start_bronze, start_silver

TYPE2 = "geo.public_silver.scalars_type2"


def flush(path, buffer, **extra):
    record = dict(
        write_type="raw", raw_file_path=path, table_name="geo.public.scalars", extract_job_id="job-1",
        extract_buffer_id=buffer, extract_type="stream", extract_start_at="2026-05-31T02:50:21.544690220Z",
        extract_end_at="2026-05-31T02:51:21.544690220Z", source_instance_name="i", source_database_name="geo",
        source_schema_name="public", source_table_name="scalars", source_min_lsn=1, source_max_lsn=9,
    )
    record.update(extra)
    return json.dumps(record)


def run(query):
    query.awaitTermination(240)
    assert query.exception() is None


def test_streams_end_to_end(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "lake"), buckets=4)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    inbox, outbox = tmp_path / "in", tmp_path / "out"
    inbox.mkdir(), outbox.mkdir()
    files = {}
    for number, (buffer, lines) in enumerate(
        {
            "b1": [envelope("b1", "c", 1, 10, V1[0]), envelope("b1", "c", 2, 11, V1[0])],
            "b2": [envelope("b2", "u", 1, 20, V2[0]), envelope("b2", "d", 2, 21)],
        }.items()
    ):
        name = f"geo.public.scalars-2026-05-31_02-51-21-000-{number:06d}.jsonl"
        files[buffer] = write_lines(str(tmp_path / name), lines)
    missing = str(tmp_path / "geo.public.scalars-2026-05-31_02-51-21-000-000009.jsonl")
    write_lines(str(inbox / "1.jsonl"), [
        flush(files["b1"], "b1"), flush(files["b2"], "b2"), flush(missing, "b9"), "not json", "",
    ])

    def bronze():
        return start_bronze(spark, store, ledger, str(inbox), str(outbox), str(tmp_path / "cp1"), wait=0)

    def silver():
        return start_silver(spark, store, ledger, str(outbox), str(tmp_path / "cp2"))

    run(bronze())
    run(silver())
    shown = ("id", "_source_lsn", "_is_current", "_is_deleted")
    expected = [(1, 10, False, False), (1, 20, True, False), (2, 11, False, True)]

    def rows():
        return sorted(tuple(r) for r in store.read(TYPE2).select(*shown).collect())

    assert rows() == expected
    letters = ledger.read("dead_letters").collect()
    assert sorted((r["extract_buffer_id"], r["original_topic"]) for r in letters) == [
        ("b9", "cdc-file-write"), ("unknown", "cdc-file-write")
    ]
    # The same files announced again are not loaded again; a repeated table notification changes nothing.
    write_lines(str(inbox / "2.jsonl"), [flush(files["b1"], "b1"), flush(files["b2"], "b2")])
    run(bronze())
    assert store.read("geo.public_bronze.scalars").count() == 4
    sent = [p for p in outbox.iterdir() if p.name.startswith("part-")]
    write_lines(str(outbox / "again.txt"), [line for p in sent for line in p.read_text().splitlines()])
    run(silver())
    assert rows() == expected
    writes = ledger.read("table_writes").groupBy("write_type").sum("write_row_count").collect()
    counted = {r[0]: r[1] for r in writes}
    assert counted["bronze"] == 4
    metrics = ledger.read("run_metrics").select("operation", "outcome").distinct().collect()
    assert {tuple(r) for r in metrics} >= {
        ("table_writer.process_record.records", "success"), ("table_writer.process_record.records", "error"),
        ("type2_dimension.process_record.records", "success"),
    }


def batch_of(spark, *lines):
    return parse_messages(spark.createDataFrame([(line,) for line in lines], "value string"), FILE_FLUSH)


def test_no_buffer_is_lost_on_restart_and_none_loaded_twice(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "lake"), buckets=4)
    sent, letters = [], []
    ledger = Ledger(spark, str(tmp_path / "ledger"), lambda rows: letters.extend(rows.collect()))
    path = write_lines(
        str(tmp_path / "geo.public.scalars-2026-05-31_02-51-21-000-000001.jsonl"), [envelope("b1", "c", 1, 10, V1[0])]
    )
    # Named twice in one batch, among many unreadable records.
    batch = batch_of(spark, flush(path, "b1"), flush(path, "b1"), *(f"bad {i}" for i in range(200)))

    def down(_):
        raise OSError("no sink")

    with pytest.raises(OSError):
        bronze_batch(spark, store, ledger, batch, down)
    assert ledger.read("table_writes").count() == 0
    assert store.read("geo.public_bronze.scalars").count() == 1
    for _ in range(2):  # the replay announces the buffer, once it has been announced nothing is sent
        bronze_batch(spark, store, ledger, batch, lambda rows: sent.extend(rows.collect()))
    assert [r["key"] for r in sent] == ["b1"] and store.read("geo.public_bronze.scalars").count() == 1
    said = json.loads(sent[0]["value"])
    assert said["format"] == "PARQUET" and said["load_date"] == str(spark.sql("SELECT current_date()").first()[0])
    assert len(letters) == 600 and json.loads(letters[0]["value"])["original_payload"].startswith("bad")


def test_a_file_that_comes_later_is_loaded_and_one_that_never_comes_is_a_dead_letter(spark, tmp_path):
    store, ledger, sent = FolderStore(spark, str(tmp_path / "lake"), buckets=4), Ledger(spark, str(tmp_path / "ledger")), []
    late, never, here = (str(tmp_path / f"geo.public.scalars-2026-05-31_02-51-21-000-00000{n}.jsonl") for n in range(3))
    write_lines(here, [envelope("b2", "c", 3, 12, V1[0])])

    def batch(wait, *lines):
        records = batch_of(spark, *lines) if lines else None
        bronze_batch(spark, store, ledger, records, lambda rows: sent.extend(r["key"] for r in rows.collect()), wait=wait)

    batch(600, flush(late, "b0"), flush(never, "b1"))
    assert sent == [] and ledger.read("dead_letters").isEmpty() and set(ledger.waiting_files()) == {late, never}
    write_lines(late, [envelope("b0", "c", 1, 10, V1[0])])
    batch(600, flush(here, "b2"))
    assert sorted(sent) == ["b0", "b2"] and set(ledger.waiting_files()) == {never}
    batch(0)
    letters = ledger.read("dead_letters").collect()
    assert [(r["extract_buffer_id"], r["exception_class"]) for r in letters] == [("b1", "builtins.FileNotFoundError")]
    assert not ledger.waiting_files() and store.read("geo.public_bronze.scalars").count() == 2


def test_a_group_that_fails_is_given_up_before_its_files_are_loaded_singly(spark, tmp_path, monkeypatch):
    store, ledger = FolderStore(spark, str(tmp_path / "lake"), buckets=4), Ledger(spark, str(tmp_path / "ledger"))
    files = [str(tmp_path / f"geo.public.scalars-2026-05-31_02-51-21-000-00000{n}.jsonl") for n in range(2)]
    for n, path in enumerate(files):
        write_lines(path, [envelope(f"b{n}", "c", n, 10 + n, V1[0])])
    real, calls = store.create_append, []

    def once_down(*args):
        calls.append(args)
        if len(calls) == 1:
            raise OSError("the store is out of reach")
        return real(*args)

    monkeypatch.setattr(store, "create_append", once_down)
    batch = batch_of(spark, *(flush(path, f"b{n}") for n, path in enumerate(files)))
    for _ in range(2):
        bronze_batch(spark, store, ledger, batch, str(tmp_path / "out"))
        assert store.read("geo.public_bronze.scalars").count() == 2 and len(calls) == 3
    found = ledger.loads_of_files(files)
    assert [found[p]["states"] for p in files] == [{"begun", "loaded", "announced"}] * 2
    assert found[files[0]]["load"] != found[files[1]]["load"] and ledger.read("dead_letters").isEmpty()


@pytest.mark.parametrize(("notified", "file", "same"), [
    ("/a/b.jsonl", "file:///a/b.jsonl", True), ("file:/a/b c.jsonl", "file:///a/b%20c.jsonl", True), ("/a", "file:///a/b.jsonl", True),
    ("s3a://x/a/*.json", "s3a://x/a/1.json", True), ("/a/b", "file:///a/bc", False), ("/a/*.json", "file:///b/1.json", False),
])
def test_raw_files_are_told_by_their_notification(notified, file, same):
    assert named_by(notified, file) is same


def test_buffers_of_several_load_days(spark, tmp_path):
    store = FolderStore(spark, str(tmp_path / "lake"), buckets=4)
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    fqn = "geo.public_bronze.scalars"
    rows = spark.createDataFrame(
        [("old", 1, 10, 20), ("new", 2, 11, 31), ("old", 3, 12, 31)], "_extract_buffer_id string, after_id long, _source_lsn long, _day int"
    ).selectExpr(
        "*", "after_id AS before_id", "timestamp'2026-05-31' AS after_updated_at", "'c' AS _op", "0L AS _ts_ms", "2026 AS _year", "5 AS _month"
    )
    store.create_append(fqn, rows)
    for loads in (
        [("new", date(2026, 5, 31), 1), ("old", date(2026, 5, 31), 2)],  # not all rows of "old" are there
        [("new", date(2026, 5, 31), 1)],  # nothing known of "old"
        [("new", date(2026, 5, 31), 1), ("old", date(2026, 5, 20), 1), ("old", date(2026, 5, 31), 1)],
    ):
        transform_buffers(spark, store, fqn, ["old", "new"], ScdSpec(), ledger, loads=loads)
        assert sorted(r[0] for r in store.read(TYPE2).select("id").collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="none"):
        transform_buffers(spark, store, fqn, ["new", "none"], ScdSpec(), ledger)
