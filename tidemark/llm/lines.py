"""Line deduplication by overlapping windows of three lines.

Every three consecutive lines of a text are hashed. A window found anywhere before, in ascending order of (document, row, line), is a later
occurrence; the lines that later occurrences cover, overlapping or not, are merged into one set and removed. Windows of blank lines only are no
evidence.

The earliest place of each window is a minimum, combined before the shuffle, so that a window in a third of all documents is no hot
group; windows are then compared with the earliest places of repeated windows only, in a plain join that adaptive execution splits.

**Cases.** Null texts count as one empty line; texts of fewer than three lines stay whole. Rows of equal id are ordered by a number given to
them when they are first written. Repeated rows lose what the first of them has. Only DataFrame functions are used; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blank_if_null
from tidemark.operators.scratch import written


def _windows(lines: Column) -> Column:
    at = F.when(F.size(lines) >= 3, F.sequence(F.lit(1), F.size(lines) - 2))

    def hashed(i: Column) -> Column:
        three = F.slice(lines, i, F.lit(3))
        return F.when(F.exists(three, lambda x: F.trim(x) != ""), F.struct(F.xxhash64(three).alias("h1"), F.xxhash64(three, F.lit(3)).alias("h2")))

    return F.transform(at, hashed)


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` (what is left) of every row of ``docs`` (``doc_id``, ``text``)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank_if_null().alias("text"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()))
    split = rows.select("doc_id", "row", F.split("text", "\n").alias("lines"))
    window = split.select("doc_id", "row", F.posexplode(_windows(F.col("lines"))).alias("at", "w")).filter("w IS NOT NULL")
    window = written(window.select("doc_id", "row", "at", "w.h1", "w.h2"))
    place = F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), "row", "at")
    first = window.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = window.withColumn("place", place).join(first, ["h1", "h2"]).filter(F.col("place") > F.col("first"))
    covered = later.groupBy("row").agg(F.collect_set("at").alias("at"))  # lines of one text
    out = rows.join(covered, "row", "left").withColumn("lines", F.split("text", "\n"))
    gone = F.flatten(F.transform(F.coalesce("at", F.array().cast("array<int>")), lambda i: F.array(i, i + 1, i + 2)))
    out = out.withColumn("gone", F.array_distinct(gone))
    kept = F.when(F.size("gone") == 0, F.col("text")).otherwise(F.array_join(F.filter("lines", lambda x, i: ~F.array_contains("gone", i)), "\n"))
    return out.select("doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_removed"), kept.alias("text"))
