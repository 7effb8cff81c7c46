"""Silver history queries: a change log derived from ``events`` or ``orders`` through the type-2 operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.changes import (
    changed_upserts,
    close_deleted,
    closed,
    latest_deletes,
    lineage_refresh,
    tombstones as tombstone_rows,
)
from tidemark.operators.flatten import deletes, upserts
from tidemark.operators.incremental import extend_type2, key_state, with_new_versions
from tidemark.operators.scratch import written
from tidemark.operators.silver import as_of, derive_type1, ensure_layout, type1_of_complete
from tidemark.operators.skew import with_ordinals
from tidemark.operators.versions import build_type2
from tidemark.functions.keys import primary_key, version_key as version_key_expr
from tidemark.spec import ScdSpec
from workloads.registry import epoch_millis, query, shown, table

SPEC = ScdSpec()
CUT = "2024-01-15 00:00:00"

HISTORY = (
    "id", "name", "value", "_source_lsn", "_extract_buffer_id", "_valid_from", "_valid_to", "_is_current",
    "_is_deleted", "primary_key", "version_key", "natural_key", "_record_number", "_record_count", "_last_lsn",
)


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change per event: errors delete the user's row, signups create it, everything else updates it."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    return events.select(
        F.col("user_id").alias("id"),
        kind.alias("name"),
        "value",
        F.col("ts").alias("updated_at"),
        F.when(kind == "error", "d").when(kind == "signup", "c").otherwise("u").alias("_op"),
        F.col("event_id").alias("_source_lsn"),
        epoch_millis(F.col("ts")).alias("_ts_ms"),
        F.lit("job-1").alias("_extract_job_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("_extract_buffer_id"),
        F.lit("stream").alias("_extract_type"),
    )


EVENT_CHANGES = """
e AS (
  SELECT user_id AS id, event_type AS name, value, ts AS updated_at, event_id AS _source_lsn,
         CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS _op,
         epoch_us(ts) // 1000 AS _ts_ms, strftime(ts, '%Y-%m-%d') AS _extract_buffer_id, 'job-1' AS _extract_job_id,
         'stream' AS _extract_type
  FROM events)
"""

ORDER_CHANGES = """
e AS (
  SELECT {key} AS id, o_orderpriority AS name, o_totalprice AS value, date_trunc('{unit}', o_orderdate) AS updated_at,
         o_orderkey AS _source_lsn, CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END AS _op,
         epoch_us(o_orderdate) // 1000 AS _ts_ms, o_orderpriority AS _extract_buffer_id
  FROM orders)
"""


def order_changes(spark: SparkSession, sf_dir: str, key: str, unit: str) -> DataFrame:
    """Orders as changes of their customer (or any key): stamps repeat and run backwards."""
    return table(spark, sf_dir, "orders").select(
        F.col(key).alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("value"),
        F.date_trunc(unit, "o_orderdate").cast("timestamp_ntz").alias("updated_at"),
        F.when(F.col("o_orderstatus") == "P", "d").otherwise("u").alias("_op"),
        F.col("o_orderkey").alias("_source_lsn"),
        epoch_millis(F.col("o_orderdate")).alias("_ts_ms"),
        F.col("o_orderpriority").alias("_extract_buffer_id"),
    )


# The type-2 rule over a change log ``e``; ``t2`` holds the versions.
VERSIONS = """
a AS (
  SELECT *, _op = 'd' AS del, lag(_op = 'd') OVER w AS pdel, lag(updated_at) OVER w AS pstamp
  FROM e WINDOW w AS (PARTITION BY id ORDER BY _source_lsn)),
b AS (
  SELECT *, sum(CASE WHEN pdel IS NOT NULL AND ((pdel AND del) OR (NOT pdel AND NOT del AND pstamp = updated_at))
                THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY _source_lsn ROWS UNBOUNDED PRECEDING) AS run
  FROM a),
r AS (
  SELECT id, run, bool_or(del) AS del, min(_source_lsn) AS _source_lsn, max(_source_lsn) AS seen,
         arg_min(name, _source_lsn) AS name, arg_min(value, _source_lsn) AS value,
         arg_min(updated_at, _source_lsn) AS stamp, arg_min(_extract_buffer_id, _source_lsn) AS first_buffer,
         arg_max(_extract_buffer_id, _source_lsn) AS last_buffer, arg_max(_ts_ms, _source_lsn) AS ended
  FROM b GROUP BY id, run),
n AS (
  SELECT *, lag(run) OVER w AS previous, lead(run) OVER w AS following, lead(del) OVER w AS ndel,
         lead(stamp) OVER w AS nstamp, lead(ended) OVER w AS nended, lead(seen) OVER w AS nseen
  FROM r WINDOW w AS (PARTITION BY id ORDER BY run)),
v AS (
  SELECT id, name, value, _source_lsn,
         CASE WHEN del THEN first_buffer ELSE last_buffer END AS _extract_buffer_id,
         CAST(CASE WHEN del THEN TIMESTAMP '1970-01-01 00:00:00' ELSE stamp END AS VARCHAR) AS _valid_from,
         CAST(CASE WHEN del THEN make_timestamp(ended * 1000)
                   WHEN following IS NULL THEN TIMESTAMP '9999-12-31 23:59:59.999999'
                   WHEN ndel THEN make_timestamp(nended * 1000)
                   ELSE nstamp - INTERVAL 1 MICROSECOND END AS VARCHAR) AS _valid_to,
         following IS NULL AS _is_current, del OR coalesce(ndel, false) AS _is_deleted,
         id || '-' || _source_lsn AS primary_key,
         CASE WHEN coalesce(ndel, false) THEN greatest(seen, nseen) ELSE seen END AS _last_lsn
  FROM n WHERE NOT del OR previous IS NULL),
t2 AS (
  SELECT v.*, sha256(primary_key || '|' || _valid_from) AS version_key, id AS natural_key,
         CAST(row_number() OVER (PARTITION BY id ORDER BY _source_lsn) AS INTEGER) AS _record_number,
         CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS _record_count
  FROM v)
"""
SHOW_HISTORY = "SELECT " + ", ".join(HISTORY) + " FROM t2"
WITH_DELETES = f"WITH {EVENT_CHANGES}, {VERSIONS} {SHOW_HISTORY}"

# The plain rule without deletes: the next version's stamp ends the one before.
UPSERTS_ONLY = """
SELECT user_id AS id, event_type AS name, value, event_id AS _source_lsn,
       strftime(ts, '%Y-%m-%d') AS _extract_buffer_id, CAST(ts AS VARCHAR) AS _valid_from,
       CAST(coalesce(lead(ts) OVER w - INTERVAL 1 MICROSECOND, TIMESTAMP '9999-12-31 23:59:59.999999') AS VARCHAR)
         AS _valid_to,
       lead(ts) OVER w IS NULL AS _is_current, false AS _is_deleted, user_id || '-' || event_id AS primary_key,
       sha256(user_id || '-' || event_id || '|' || CAST(ts AS VARCHAR)) AS version_key, user_id AS natural_key,
       CAST(row_number() OVER w AS INTEGER) AS _record_number,
       CAST(count(*) OVER (PARTITION BY user_id) AS INTEGER) AS _record_count, event_id AS _last_lsn
FROM events WHERE event_type <> 'error' WINDOW w AS (PARTITION BY user_id ORDER BY event_id)
"""


@query(UPSERTS_ONLY)
def scd2_history(spark, sf_dir):
    changes = upserts(event_changes(spark, sf_dir), SPEC)
    return shown(build_type2(changes, SPEC), *HISTORY)


@query(WITH_DELETES)
def scd2_with_deletes(spark, sf_dir):
    return shown(build_type2(event_changes(spark, sf_dir), SPEC), *HISTORY)


def _two_buffers(spark, sf_dir, first, second, bronze):
    # Stored, as in the job: the silver table, and the state of the touched keys.
    silver = written(build_type2(first, SPEC))
    state = written(key_state(second, silver, SPEC))
    delta = extend_type2(state, second, silver, bronze, SPEC)
    return shown(with_new_versions(silver, delta, state, SPEC), *HISTORY)


@query(WITH_DELETES)
def scd2_incremental_equals_batch(spark, sf_dir):
    """Two buffers in order: the second extends each key's last version; earlier versions and bronze are not read again."""
    changes = event_changes(spark, sf_dir)
    early = F.col("updated_at") < F.lit(CUT).cast("timestamp_ntz")
    return _two_buffers(spark, sf_dir, changes.where(early), changes.where(~early), None)


@query(WITH_DELETES)
def scd2_late_buffer(spark, sf_dir):
    """The later half arrives first: keys the earlier half touches are rebuilt from bronze."""
    changes = event_changes(spark, sf_dir)
    early = F.col("updated_at") < F.lit(CUT).cast("timestamp_ntz")
    return _two_buffers(spark, sf_dir, changes.where(~early), changes.where(early), changes)


@query(WITH_DELETES)
def scd2_replayed_buffer(spark, sf_dir):
    """A buffer that silver already holds changes nothing."""
    changes = event_changes(spark, sf_dir)
    replay = changes.where(F.col("updated_at") >= F.lit(CUT).cast("timestamp_ntz"))
    return _two_buffers(spark, sf_dir, changes, replay, changes)


@query(f"WITH {EVENT_CHANGES}, {VERSIONS} {SHOW_HISTORY} WHERE NOT _is_current")
def closed_versions(spark, sf_dir):
    """What is no longer so: superseded and deleted versions."""
    return shown(closed(build_type2(event_changes(spark, sf_dir), SPEC)), *HISTORY)


@query(f"WITH {ORDER_CHANGES.format(key='o_custkey', unit='year')}, {VERSIONS} {SHOW_HISTORY}")
def scd2_repeated_stamps(spark, sf_dir):
    """Changes without a new stamp refresh lineage only; stamps that run backwards still load."""
    return shown(build_type2(order_changes(spark, sf_dir, "o_custkey", "year"), SPEC), *HISTORY)


@query(f"WITH {ORDER_CHANGES.format(key='o_orderstatus', unit='month')}, {VERSIONS} {SHOW_HISTORY}")
def scd2_hot_keys(spark, sf_dir):
    """Three keys with a third of all rows each, worked on in chunks."""
    changes = order_changes(spark, sf_dir, "o_orderstatus", "month")
    return shown(build_type2(changes, ScdSpec(hot_rows=max(1, changes.count() // 12))), *HISTORY)


@query(f"WITH {EVENT_CHANGES}, {VERSIONS} {SHOW_HISTORY} WHERE _valid_from = '1970-01-01 00:00:00'")
def scd2_leading_tombstones(spark, sf_dir):
    history = build_type2(event_changes(spark, sf_dir), SPEC)
    return shown(history.where(F.col("_op") == "d"), *HISTORY)


CUSTOMER_DELETES = """
d AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS value, 1000000000 + c_custkey AS _source_lsn, 1767225600000 + c_custkey * 7 AS _ts_ms
      FROM customer)
"""
ORDER_UPSERTS = ORDER_CHANGES.format(key="o_custkey", unit="day").replace("CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END", "'u'")


def _orders_and_deletes(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """All orders as versions of their customer, and a later delete of every customer, with orders or without."""
    orders = order_changes(spark, sf_dir, "o_custkey", "day").withColumn("_op", F.lit("u"))
    gone = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("value"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.lit("d").alias("_op"),
        (F.col("c_custkey") + 1_000_000_000).alias("_source_lsn"), (F.col("c_custkey") * 7 + 1_767_225_600_000).alias("_ts_ms"),
        F.lit("gone").alias("_extract_buffer_id"),
    )
    return orders, gone


@query(f"""
WITH {CUSTOMER_DELETES}
SELECT id, name, value, _source_lsn, '1970-01-01 00:00:00' AS _valid_from,
       CAST(make_timestamp(_ts_ms * 1000) AS VARCHAR) AS _valid_to, true AS _is_current, true AS _is_deleted,
       id || '-' || _source_lsn AS primary_key,
       sha256(id || '-' || _source_lsn || '|1970-01-01 00:00:00') AS version_key, id AS natural_key,
       1 AS _record_number, 1 AS _record_count
FROM d WHERE id NOT IN (SELECT o_custkey FROM orders)
""")
def tombstones(spark, sf_dir):
    """Deletes of all customers, of whom silver knows those with orders."""
    orders, gone = _orders_and_deletes(spark, sf_dir)
    columns = [c for c in HISTORY if c not in ("_extract_buffer_id", "_last_lsn")]
    return shown(tombstone_rows(gone, build_type2(orders, SPEC), SPEC), *columns)


SILVER_AT_CUT = f"""
s AS (SELECT * FROM e WHERE _op <> 'd' AND updated_at < TIMESTAMP '{CUT}'),
tip AS (SELECT *, CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS n FROM s
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY _source_lsn DESC) = 1)
"""
CLOSED_COLUMNS = (
    "id", "name", "value", "_source_lsn", "_valid_from", "_valid_to", "_is_current", "_is_deleted", "primary_key",
)
CLOSED = f"""
WITH {ORDER_UPSERTS}, {VERSIONS}, {CUSTOMER_DELETES}
SELECT t2.id, t2.name, t2.value, t2._source_lsn, _valid_from, CAST(make_timestamp(d._ts_ms * 1000) AS VARCHAR) AS _valid_to,
       false AS _is_current, true AS _is_deleted, primary_key, {{numbers}}
FROM t2 JOIN d ON t2.id = d.id WHERE _record_number = _record_count
"""


@query(CLOSED.format(numbers="_record_number, _record_count"))
def delete_close(spark, sf_dir):
    """A delete of every customer ends the last version of those that silver knows."""
    orders, gone = _orders_and_deletes(spark, sf_dir)
    rows = close_deleted(gone, build_type2(orders, SPEC), SPEC)
    return shown(rows, *CLOSED_COLUMNS, "_record_number", "_record_count")


@query(CLOSED.format(numbers="1 AS _record_number, 1 AS _record_count"))
def delete_close_without_numbers(spark, sf_dir):
    """The same in a table from before record numbers: the row to close is found by a window, and gets numbers."""
    orders, gone = _orders_and_deletes(spark, sf_dir)
    silver = build_type2(orders, SPEC).drop("_record_number", "_record_count")
    return shown(close_deleted(gone, silver, SPEC), *CLOSED_COLUMNS, "_record_number", "_record_count")


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS.replace("ELSE last_buffer END", "ELSE 'z-copy' END")} {SHOW_HISTORY}
""")
def scd2_copies(spark, sf_dir):
    """Every event twice: the image of the first copy to arrive counts, and the lineage of the last."""
    changes = event_changes(spark, sf_dir)
    copies = changes.withColumns({"_extract_buffer_id": F.lit("z-copy"), "name": F.lit("copy"), "value": F.lit(-1.0)})
    return shown(build_type2(copies.unionByName(changes), SPEC), *HISTORY)


@query(f"""
WITH {EVENT_CHANGES}
SELECT id, _source_lsn, _ts_ms, name FROM e WHERE _op = 'd'
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _source_lsn DESC) = 1
""")
def latest_delete_per_key(spark, sf_dir):
    return latest_deletes(deletes(event_changes(spark, sf_dir), SPEC), SPEC).select(
        "id", "_source_lsn", "_ts_ms", "name"
    )


def _resnapshot(spark, sf_dir):
    """The history of the early half, and a later snapshot repeating every current row with its own stamp."""
    changes = upserts(event_changes(spark, sf_dir), SPEC)
    early = F.col("updated_at") < F.lit(CUT).cast("timestamp_ntz")
    silver = build_type2(changes.where(early), SPEC)
    repeated = changes.withColumns(
        {
            "_op": F.lit("r"),
            "_source_lsn": F.col("_source_lsn") + 10_000_000,
            "_extract_job_id": F.lit("job-2"),
            "_extract_buffer_id": F.concat(F.lit("snap-"), F.col("name")),
            "_extract_type": F.lit("snapshot"),
        }
    )
    return silver, repeated


@query(f"""
WITH {EVENT_CHANGES}, {SILVER_AT_CUT}
SELECT id, name, value, _source_lsn, 'job-2' AS _extract_job_id, 'snap-' || name AS _extract_buffer_id,
       'snapshot' AS _extract_type, CAST(updated_at AS VARCHAR) AS _valid_from, true AS _is_current
FROM tip
""")
def lineage_refreshed_rows(spark, sf_dir):
    silver, repeated = _resnapshot(spark, sf_dir)
    return shown(
        lineage_refresh(repeated, silver, SPEC), "id", "name", "value", "_source_lsn", "_extract_job_id",
        "_extract_buffer_id", "_extract_type", "_valid_from", "_is_current",
    )


@query(f"""
WITH {EVENT_CHANGES}, {SILVER_AT_CUT}
SELECT e.id, e.name, e.value, e._source_lsn + 10000000 AS _source_lsn, CAST(e.updated_at AS VARCHAR) AS updated_at
FROM e LEFT JOIN tip ON e.id = tip.id AND e.updated_at = tip.updated_at
WHERE e._op <> 'd' AND tip.id IS NULL
""")
def changed_upserts_only(spark, sf_dir):
    silver, repeated = _resnapshot(spark, sf_dir)
    return shown(changed_upserts(repeated, silver, SPEC), "id", "name", "value", "_source_lsn", "updated_at")


TYPE1 = ("id", "name", "value", "_source_lsn", "_extract_buffer_id", "_is_deleted", "primary_key", "version_key",
         "natural_key", "_record_number", "_record_count")


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS}
SELECT {", ".join(TYPE1)} FROM t2 WHERE _is_current OR _is_deleted
QUALIFY row_number() OVER (PARTITION BY id ORDER BY _source_lsn DESC) = 1
""")
def type1_soft_delete(spark, sf_dir):
    """Latest state per key, deleted keys kept and marked."""
    return derive_type1(build_type2(event_changes(spark, sf_dir), SPEC), SPEC).select(*TYPE1)


@query(f"""
WITH {EVENT_CHANGES}
SELECT id, name, value, _source_lsn, CAST(count(*) OVER (PARTITION BY id) AS INTEGER) AS _record_count FROM e
WHERE _op <> 'd' QUALIFY row_number() OVER (PARTITION BY id ORDER BY _source_lsn DESC) = 1
""")
def type1_current(spark, sf_dir):
    """Latest state from a complete history: its last records, by a filter alone."""
    history = build_type2(upserts(event_changes(spark, sf_dir), SPEC), SPEC)
    return type1_of_complete(history).select("id", "name", "value", "_source_lsn", "_record_count")


@query(f"""
WITH {EVENT_CHANGES}, {VERSIONS}
SELECT id, name, value, _valid_from, _valid_to, _record_number FROM t2
WHERE CAST(_valid_from AS TIMESTAMP) <= TIMESTAMP '{CUT}' AND TIMESTAMP '{CUT}' <= CAST(_valid_to AS TIMESTAMP)
""")
def point_in_time(spark, sf_dir):
    history = build_type2(event_changes(spark, sf_dir), SPEC)
    return shown(as_of(history, CUT), "id", "name", "value", "_valid_from", "_valid_to", "_record_number")


NUMBERED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {key} AS grp,
       CAST(row_number() OVER w AS INTEGER) AS _record_number,
       CAST(count(*) OVER (PARTITION BY {key}) AS INTEGER) AS _record_count
FROM lineitem
WINDOW w AS (PARTITION BY {key} ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate)
"""
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")


def _numbered(spark, sf_dir, key, spec):
    rows = table(spark, sf_dir, "lineitem").withColumn("grp", F.col(key)).select("grp", *LINE_ORDER)
    return with_ordinals(rows, ["grp"], LINE_ORDER, spec).select(
        *LINE_ORDER[:4], "grp", "_record_number", "_record_count"
    )


@query(NUMBERED.format(key="l_partkey"))
def record_numbering(spark, sf_dir):
    return _numbered(spark, sf_dir, "l_partkey", SPEC)


@query(NUMBERED.format(key="l_returnflag"))
def record_numbering_hot_keys(spark, sf_dir):
    """Three keys hold all rows: numbered by chunk, offsets carried over."""
    rows = table(spark, sf_dir, "lineitem").count()
    return _numbered(spark, sf_dir, "l_returnflag", ScdSpec(hot_rows=max(1, rows // 12)))


@query("""
SELECT o_orderkey AS id, o_custkey || '-' || o_orderkey AS primary_key,
       sha256(o_custkey || '-' || o_orderkey || '|' || CAST(o_orderdate AS VARCHAR)) AS version_key
FROM orders
""")
def version_keys(spark, sf_dir):
    spec = ScdSpec(keys=("o_custkey",), order_col="o_orderkey", change_col="o_orderdate")
    orders = table(spark, sf_dir, "orders").withColumn("primary_key", primary_key(spec))
    stamp_type = orders.schema["o_orderdate"].dataType
    return orders.select(
        F.col("o_orderkey").alias("id"),
        "primary_key",
        version_key_expr(stamp_type, valid_from="o_orderdate").alias("version_key"),
    )


@query(UPSERTS_ONLY.replace("event_id AS _last_lsn", "CAST(NULL AS BIGINT) AS _last_lsn"))
def legacy_layout_backfill(spark, sf_dir):
    """A history from before the deleted flag and the version key, brought to today's layout."""
    history = build_type2(upserts(event_changes(spark, sf_dir), SPEC), SPEC)
    old = history.drop("_is_deleted", "version_key", "_last_lsn")
    return shown(ensure_layout(old, SPEC), *HISTORY)
