import random
from datetime import timedelta

import pytest

from tests.walk import DAY0, END, SCHEMA, SHOWN, expected, random_log, text
from tidemark.operators.incremental import extend_type2, key_state, last_versions, with_new_versions
from tidemark.operators.versions import build_type2
from tidemark.spec import END_OF_TIME_YEAR_10000, ScdSpec

PLAIN = ScdSpec(arrival=("_extract_buffer_id", "_extract_job_id"))


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*SHOWN).collect()), key=lambda r: (r[0], r[2]))


def logs(seed, keys, **kwargs):
    rng = random.Random(seed)
    rows = [row for key in range(keys) for row in random_log(rng, key, **kwargs)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot_rows,keys", [(5_000_000, 400), (6, 120), (3, 40), (1, 12)])
def test_matches_walk(spark, hot_rows, keys):
    rows = logs(keys, keys)
    spec = ScdSpec(arrival=PLAIN.arrival, hot_rows=hot_rows)
    got = rows_of(build_type2(spark.createDataFrame(rows, SCHEMA).repartition(5), spec))
    assert got == expected(rows)


def test_one_key_holding_most_rows(spark):
    rng = random.Random(7)
    rows = logs(2, 30)
    for lsn in range(1, 900):
        rows.append((7, f"h{lsn}", None if lsn % 50 > 40 else DAY0 + timedelta(days=lsn // 70), "d" if lsn % 50 > 40 else "u",
                     1000 + lsn, 1_780_000_000_000 + lsn, f"b{lsn % 6}", f"j{lsn % 10}"))
    rng.shuffle(rows)
    spec = ScdSpec(arrival=PLAIN.arrival, hot_rows=60)
    got = rows_of(build_type2(spark.createDataFrame(rows, SCHEMA).repartition(4), spec))
    assert got == expected(rows)


def test_long_runs_over_several_chunks(spark):
    """One version refreshed, and one deletion repeated, far beyond one chunk."""
    rows = [(1, f"n{i}", DAY0, "u", i, 1_780_000_000_000, "b1", f"j{i % 10}") for i in range(1, 300)]
    rows += [(1, f"n{i}", None, "d", i, 1_780_000_000_000 + i, "b2", f"j{i % 10}") for i in range(300, 600)]
    rows += [(2, f"n{i}", None, "d", i, 1_780_000_000_000 + i, "b2", f"j{i % 10}") for i in range(1, 400)]
    rows += [(2, "again", DAY0, "c", 400, 1_780_000_000_000, "b3", "j1")]
    spec = ScdSpec(arrival=PLAIN.arrival, hot_rows=40)
    assert rows_of(build_type2(spark.createDataFrame(rows, SCHEMA), spec)) == expected(rows)


def test_copies_of_one_event_never_pile_up(spark):
    rows = [(1, "n", DAY0, "u", 5, 0, f"b{i:04d}", "j") for i in range(500)]
    rows += [(1, "m", None, "d", 6, 1_000, "b", "j"), (2, "n", DAY0, "c", 1, 0, "b", "j")]
    spec = ScdSpec(arrival=PLAIN.arrival, hot_rows=10)
    assert rows_of(build_type2(spark.createDataFrame(rows, SCHEMA), spec)) == expected(rows)


@pytest.mark.parametrize("hot_rows", [10**6, 5])
def test_composite_keys_and_year_10000(spark, hot_rows):
    rows = logs(21, 25)
    plain = spark.createDataFrame(rows, SCHEMA)
    split = plain.selectExpr("id div 5 AS a", "id % 5 AS b", "* EXCEPT (id)")
    spec = ScdSpec(
        keys=("a", "b"), arrival=PLAIN.arrival, hot_rows=hot_rows, end_of_time=END_OF_TIME_YEAR_10000
    )
    got = build_type2(split, spec).selectExpr(
        "a * 5 + b AS id", "_source_lsn", "cast(_valid_to AS string) AS ends", "_is_current", "primary_key",
        "natural_key", "_record_number", "_record_count",
    ).collect()
    want = []
    for r in expected(rows):
        named = dict(zip(SHOWN, r))
        key = f"{r[0] // 5}-{r[0] % 5}"
        ends = named["_valid_to"]
        ends = "+10000-12-31 23:59:59.999999" if ends == END else text(ends)
        want.append((r[0], named["_source_lsn"], ends, named["_is_current"], f"{key}-{named['_source_lsn']}", key,
                     named["_record_number"], named["_record_count"]))
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("seed,in_order,hot_rows", [(11, True, 10**6), (12, False, 10**6), (13, True, 20)])
def test_buffers_one_by_one_equal_one_batch(spark, seed, in_order, hot_rows):
    spec = ScdSpec(arrival=PLAIN.arrival, hot_rows=hot_rows)
    rows = logs(seed, 80, conflicts=False)
    if hot_rows < 100:
        for key, lsn, *_ in ((r[0], r[4]) for r in list(rows) if r[0] == 5):
            rows += [(key, f"m{lsn}{i}", DAY0 + timedelta(hours=i // 3), "u", lsn * 100 + i, 0, f"b{i % 6}", f"k{i}")
                     for i in range(9)]
    rng = random.Random(seed)
    if in_order:
        rows.sort(key=lambda r: r[4])
        bounds = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]
        buffers = [rows[a:b] for a, b in zip(bounds, bounds[1:])]
    else:
        buffers = [[], [], []]
        for row in rows:
            buffers[rng.randrange(3)].append(row)
    silver, seen = None, []
    for buffer in [*buffers, buffers[1]]:
        seen += buffer
        changes = spark.createDataFrame(buffer, SCHEMA)
        bronze = spark.createDataFrame(seen, SCHEMA)
        state = key_state(changes, silver, spec)
        delta = extend_type2(state, changes, silver, bronze, spec)
        after = delta if silver is None else with_new_versions(silver, delta, state, spec)
        silver = spark.createDataFrame(after.collect(), after.schema)
    assert rows_of(silver) == expected(seen)
    assert rows_of(build_type2(spark.createDataFrame(seen, SCHEMA), spec)) == expected(seen)


def test_increments_touch_the_tip_only(spark):
    """What an in-order increment writes, and what it reads of silver, does not depend on how long the history is."""
    for length in (5, 50):
        rows = [(k, f"n{i}", DAY0 + timedelta(days=i), "u", i, 0, "b", "j") for k in range(6) for i in range(length)]
        silver = build_type2(spark.createDataFrame(rows, SCHEMA), PLAIN)
        changes = spark.createDataFrame([(k, "new", DAY0 + timedelta(days=900), "u", 1000, 0, "c", "j") for k in range(4)], SCHEMA)
        tips = spark.createDataFrame(last_versions(silver).collect(), silver.schema)  # nothing but these is needed
        state = key_state(changes, tips, PLAIN)
        delta = extend_type2(state, changes, tips, None, PLAIN)
        got = sorted((r.id, r._record_number, r._record_count, r._is_current) for r in delta.collect())
        assert got == [(k, length + i, length + 1, bool(i)) for k in range(4) for i in (0, 1)]
        want = expected(rows + [tuple(r) for r in changes.collect()])
        assert rows_of(with_new_versions(silver, delta, state, PLAIN)) == want


def test_copies_that_arrived_alike_count_the_same_at_any_threshold(spark):
    rows = [(1, f"{c}{i}", DAY0 + timedelta(days=i % 7), "u", i, 0, "b", f"j{c}") for i in range(300) for c in "xy"]
    changes = spark.createDataFrame(rows, SCHEMA)
    for arrival in ((), PLAIN.arrival[:1]):
        found = []
        for seed, hot_rows in ((3, 10**9), (5, 50)):
            spec = ScdSpec(arrival=arrival, hot_rows=hot_rows)
            got = build_type2(changes.repartition(seed), spec)
            found.append(sorted((tuple(map(str, r)) for r in got.select(sorted(got.columns)).collect())))
        assert found[0] == found[1]
