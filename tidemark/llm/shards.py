"""Shards of near equal bytes: a k-d tree over the rows' metadata.

A node of the tree is split along the dimension in which its rows spread widest, at the weighted median of the rows there (the weight is
a row's bytes), until leaves hold the target bytes; leaves are the shards, and rows with like metadata share one. A node
that is to become an odd number of leaves is split in proportion.

The medians of all nodes of a level are found together, by narrowing: bytes are summed by (node, interval of the dimension), the
interval in which the median lies is cut into ``BINS`` again, and so on. Rows that agree in the dimension are told
apart by a hash of their text, then of their id, then by row number, so that no number of ties unbalances a split. Sums are combined
before their shuffle, only a row for each node and interval is sorted, and one for each node reaches the driver.

Law ``bytes``: shards differ by what one row and ``TOLERANCE`` of a node at each level make up. Copies of a text fall into one shard
as far as their metadata agree and the balance allows: a text that holds a third of all rows cannot be in one shard.

Cases: null texts are empty, null ids, dimensions or a dimension without any value count as one value below all others; equal rows may be
swapped; fewer rows than shards leave shards empty; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_ROWS, blank_if_null, positions
from tidemark.operators.scratch import written

DIMENSIONS = ("n_chars", "lang", "source")
#: Intervals that a node's current interval is cut into by one pass.
BINS = 4096
#: A split may miss its share by this part of the node's bytes.
TOLERANCE = 0.0005
#: Coordinates run from 0 to this.
SCALE = 1 << 60
#: What tells rows apart that agree in a dimension.
TIES = ("_text", "_id", "_row")


def _hashed(column: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(column), 4)


def _coordinates(rows: DataFrame, dimensions: Iterable[str]) -> DataFrame:
    """``key``: the rows' coordinates, each from 0 to ``SCALE`` over the whole table; categories have no order, so their hash is one."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    ordered = [d for d in dimensions if isinstance(kinds[d], (T.NumericType, T.DatetimeType))]

    def number(name: str) -> Column:
        if isinstance(kinds[name], T.NumericType):
            return F.col(name).cast("double")
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")

    ends = [f(number(d)).alias(f"{f.__name__}_{k}") for k, d in enumerate(ordered) for f in (F.min, F.max)]
    ends = rows.agg(*ends).first().asDict() if ordered else {}

    def coordinate(name: str) -> Column:
        if name not in ordered:
            return F.when(F.col(name).isNotNull(), _hashed(F.col(name).cast("string")))
        least, most = (ends[f"{f}_{ordered.index(name)}"] for f in ("min", "max"))
        if least is None or not most > least:
            return F.when(F.col(name).isNotNull(), F.lit(0).cast("long"))
        return ((number(name) - least) / (most - least) * float(SCALE)).cast("long")

    return rows.select(
        "*", F.array(*(F.coalesce(coordinate(d), F.lit(-1).cast("long")) for d in dimensions)).alias("_at"),
    )


def _key(axes: int) -> Column:
    """What orders a node's rows: the coordinate along the node's axis, and what tells rows apart that agree in it."""
    along = reduce(lambda rest, k: F.when(F.col("axis") == k, F.col("_at")[k]).otherwise(rest), range(axes), F.lit(None).cast("long"))
    return F.array(along, *(F.col(c) for c in TIES))


def _select(axis: str, which: str, axes: int) -> Column:
    return reduce(lambda rest, k: F.when(F.col(axis) == k, F.col(f"{which}_{k}")).otherwise(rest), range(axes), F.lit(None).cast("long"))


def _axes(rows: DataFrame, axes: int) -> list[dict]:
    """For each node that is to be split: its widest dimension, and the interval and bytes that its median is looked for in."""
    ends = [f(F.col("_at")[k]).alias(f"{f.__name__}_{k}") for k in range(axes) for f in (F.min, F.max)]
    nodes = rows.filter("leaves > 1").groupBy("node", "leaves").agg(F.sum("size").alias("bytes"), *ends)
    spreads = F.array(*(F.struct((F.col(f"max_{k}") - F.col(f"min_{k}")).alias("width"), F.lit(-k).alias("first")) for k in range(axes)))
    nodes = nodes.select("*", (-F.array_max(spreads)["first"]).alias("axis"))
    nodes = nodes.select("node", "axis", "bytes", F.expr("bytes * (leaves div 2) div leaves").alias("want"), _select("axis", "min", axes).alias("low"), _select("axis", "max", axes).alias("high"))
    return [{**row.asDict(), "fixed": [], "below": 0} for row in nodes.collect()]


def _table(rows: DataFrame, nodes: list[dict], schema: str) -> DataFrame:
    """A row for each node: as many as shards at most."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    table = rows.sparkSession.createDataFrame([tuple(n[c] for c in names) for n in nodes], schema)
    return F.broadcast(table) if len(nodes) <= BROADCAST_ROWS else table


def _intervals(rows: DataFrame, nodes: list[dict], axes: int) -> DataFrame:
    """For each node the interval, of ``BINS`` that its present one is cut into, in which its median lies."""
    looked = _table(rows, nodes, "node int, axis int, want long, fixed array<long>, low long, high long, below long")
    depth = F.size("fixed")
    inside = rows.join(looked, "node").withColumn("_key", _key(axes))
    inside = inside.withColumn("_value", F.get("_key", depth))
    inside = inside.filter((F.slice("_key", F.lit(1), depth) == F.col("fixed")) & F.col("_value").between(F.col("low"), F.col("high")))
    bin_ = F.expr(f"(_value - low) div ((high - low) div {BINS} + 1)").alias("bin")
    following = F.get("_key", depth + 1)
    bins = inside.groupBy("node", "want", "below", bin_).agg(
        F.sum("size").alias("here"), F.min("_value").alias("first"), F.max("_value").alias("last"),
        F.min(following).alias("next_low"), F.max(following).alias("next_high"),
    )
    upto = F.sum("here").over(Window.partitionBy("node").orderBy("bin"))  # at most BINS rows for each node
    bins = bins.select("*", (F.col("below") + upto).alias("upto")).filter("upto >= want")
    return bins.groupBy("node").agg(F.min_by(F.struct("here", "upto", "first", "last", "next_low", "next_high"), "bin").alias("m")).select("node", "m.*")


def _cuts(rows: DataFrame, axes: int) -> list[dict]:
    """``node, axis, cut``: rows whose keys are not above the cut go left."""
    nodes, cuts = {n["node"]: n for n in _axes(rows, axes)}, []
    while nodes:
        for m in _intervals(rows, list(nodes.values()), axes).collect():
            node = nodes[m.node]
            before = m.upto - m.here
            over, under = m.upto - node["want"], node["want"] - before
            single, last_part = m.first == m.last, len(node["fixed"]) == len(TIES)
            if min(over, under) <= node["bytes"] * TOLERANCE or single and last_part:
                cuts.append({**node, "cut": [*node["fixed"], m.last if over <= under else m.first - 1]})
                del nodes[m.node]
            elif single:
                node |= {"fixed": [*node["fixed"], m.first], "low": m.next_low, "high": m.next_high, "below": before}
            else:
                node |= {"low": m.first, "high": m.last, "below": before}
    return cuts


def kd_tree(rows: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: Iterable[str] = DIMENSIONS) -> DataFrame:
    """``rows`` (``doc_id``, ``size``, ``_text`` and the dimensions) with the leaf ``shard`` of the tree that each falls into.

    Either the number of leaves is given, or the bytes that a leaf is to hold.
    """
    dimensions = list(dimensions)
    rows = written(rows.withColumns({"_row": F.monotonically_increasing_id(), "node": F.lit(0)}))
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    rows = _coordinates(rows.withColumn("_id", F.coalesce(_hashed(F.col("doc_id")), F.lit(-1).cast("long"))), dimensions)
    rows = rows.withColumn("leaves", F.lit(int(shards)))
    axes, most = len(dimensions), shards
    while most > 1:
        placed = rows.join(_table(rows, _cuts(rows, axes), "node int, axis int, cut array<long>"), "node", "left")
        left = F.slice(_key(axes), F.lit(1), F.size("cut")) <= F.col("cut")
        half = F.expr("leaves div 2")
        node = F.when(F.col("leaves") == 1, F.col("node")).when(left, F.col("node")).otherwise(F.col("node") + half)
        leaves = F.when(F.col("leaves") == 1, F.lit(1)).when(left, half).otherwise(F.col("leaves") - half)
        rows = placed.select(*(c for c in rows.columns if c not in ("node", "leaves")), node.cast("int").alias("node"), leaves.cast("int").alias("leaves"))
        rows, most = written(rows), -(-most // 2)
    return rows.withColumnRenamed("node", "shard").drop("leaves", "_at", "_id", "_row")


def sharded_rows(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, dimensions: Iterable[str] = DIMENSIONS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row: its shard, and its place there in ascending order of ``doc_id``.

    ``size`` is the UTF-8 bytes of the text (none if null) and one more.
    """
    text = blank_if_null()
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), _hashed(text).alias("_text"),
        *(F.col(d) for d in dimensions if d != "doc_id"),
    )
    rows = kd_tree(rows, shards, target_bytes, dimensions).select("doc_id", "size", "text_crc32", "shard", "_text")
    rows = positions(rows, ["shard"], [F.col("doc_id").asc_nulls_first(), F.col("_text").asc()], "slot", "_rows")
    return rows.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int | None = None, target_bytes: int | None = None, dimensions: Iterable[str] = DIMENSIONS) -> DataFrame:
    """Write the rows of ``docs`` as Parquet, one folder for each shard, and return what is written, with ``shard`` and ``slot``.

    Rows are numbered and written once before, since ids may be null or repeated; a shard's rows are dealt to as many tasks as
    adaptive execution finds right for its bytes, each sorted by ``slot``.
    """
    docs = docs.drop("shard", "slot", "_number")
    numbered = written(docs.withColumn("_number", F.monotonically_increasing_id()))
    text = blank_if_null()
    rows = numbered.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), _hashed(text).alias("_text"),
        "_number", *(F.col(d) for d in dimensions if d != "doc_id"),
    )
    rows = kd_tree(rows, shards, target_bytes, dimensions).select("doc_id", "shard", "_text", "_number")
    rows = positions(rows, ["shard"], [F.col("doc_id").asc_nulls_first(), F.col("_text").asc(), F.col("_number").asc()], "slot", "_rows")
    placed = numbered.join(rows.select("_number", "shard", "slot"), "_number").drop("_number")
    placed.hint("rebalance", "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
