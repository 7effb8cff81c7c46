"""What several operators need: sized joins, row keys, Arrow text buffers, word and shingle hashes, components."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.scratch import written

#: A side is broadcast only if it has been written, counted and found to have at most so many rows.
BROADCAST_ROWS = 500_000


def spread(spark) -> int:
    """Partitions that an exchange gets by default."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows), marked for broadcast if a count proves that it is small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_sample(rows: DataFrame, most_rows: int, most_chars: int, text: str = "text") -> DataFrame:
    """At most so many of ``rows``, of at most so many characters in all: those first by a hash of all columns.

    Equal rows are taken once, so a repeated row takes no more than its place. Rows longer than all characters allowed are left out.
    """
    rows = rows.distinct().filter(F.length(text) <= most_chars).withColumn("_h", F.xxhash64(*rows.columns))
    first = rows.orderBy("_h", *rows.columns).limit(most_rows)
    so_far = F.sum(F.length(text)).over(Window.orderBy("_h", *rows.columns))  # over the few rows taken
    return first.withColumn("_chars", so_far).filter(F.col("_chars") <= most_chars).drop("_h", "_chars")


def labelled(docs: DataFrame, marks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with their marks (one row a key), to be read several times.

    Few marks are broadcast and texts stay where they are; with more, texts are shuffled to them, once, and written.
    """
    marks = written(marks)
    if marks.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return docs.join(F.broadcast(marks), key)
    return written(docs.join(marks, key))


def bounded_batches(spark, rows: int = 512) -> None:
    """Let Arrow batches of this session hold at most ``rows`` rows: texts may be long, and Spark bounds batches by rows only."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def give_back() -> None:
    """Return what this worker has freed to the system: workers live on, and the next operator runs in the same ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def blank_if_null(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def fold(column: Column, parts: int) -> Column:
    """Remainder that deals rows into learning and held-out folds: crc32 of the value as text."""
    return F.crc32(column.cast("string").cast("binary")) % parts


def positions(rows: DataFrame, group: list[str], order: list[Column], name: str = "position", size: str = "size") -> DataFrame:
    """Written ``rows`` with each row's place (from 0) in its group by ``order``, and the group's number of rows.

    No group has to fit into a task: rows are dealt by ranges of (group, order), counted by (range, group), and the few counts
    say how many rows of the group lie in ranges before. Groups may be null. ``order`` must tell rows apart, but for
    those whose places may be swapped.
    """
    first = [F.col(g).asc_nulls_first() for g in group]
    dealt = rows.repartitionByRange(spread(rows.sparkSession), *first, *order).sortWithinPartitions(*first, *order)
    in_range = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its low bits count the rows of a partition
    dealt = written(dealt.withColumns({"_range": F.spark_partition_id(), "_at": in_range}))
    counts = dealt.groupBy("_range", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)  # at most a row for each range
    before = F.sum("_n").over(whole.orderBy("_range")) - F.col("_n")
    counts = counts.select("_range", *group, "_first", before.alias("_before"), F.sum("_n").over(whole).alias(size))
    counts = sized(written(counts))
    same = dealt["_range"] == counts["_range"]
    for g in group:
        same = same & dealt[g].eqNullSafe(counts[g])
    place = dealt["_at"] - counts["_first"] + counts["_before"]
    return dealt.join(counts, same).select(*(dealt[c] for c in rows.columns), place.alias(name), counts[size])


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (from 0) of a string column without nulls, without touching single rows."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    large = pa.types.is_large_string(array.type)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64 if large else np.int32)[array.offset : array.offset + len(array) + 1]
    at = at.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(data: np.ndarray, offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes (one row may be longer)."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


# -- words and shingles ------------------------------------------------------------------------------------------

_WORD = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20250)
_BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE_VALUES[65:91] = _BYTE_VALUES[97:123]  # A-Z count as a-z
_PLACE = _rng.integers(1, 1 << 63, 6, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (splitmix64)."""
    x = x + _WORD
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        base = 0x2545F4914F6CDD1D
        for i, b in enumerate((base, pow(base, -1, 1 << 64))):
            steps = np.full(n, b, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes and start offsets of the words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, of one buffer.

    A word's hash is a difference of running sums of byte values times powers of an odd number, so that all words are
    hashed in a few passes. Long buffers are cut at white space.
    """
    hashes, starts, at, step = [], [], 0, 1 << 20
    while at < len(data):
        end = min(len(data), at + step)
        if end < len(data):
            gap = np.flatnonzero(_SPACE[data[at:end]])
            while not len(gap) and end < len(data):  # a very long word stays whole
                end = min(len(data), end + step)
                gap = np.flatnonzero(_SPACE[data[at:end]])
            end = at + int(gap[-1]) + 1 if len(gap) and end < len(data) else end
        part = data[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = ~_SPACE[part]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _power(max(step, len(part)))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[part] * power[: len(part)], out=total[1:])
        hashes.append(mixed((total[last] - total[first]) * inverse[first]))
        starts.append(first + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def shingle_sets(array: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """For each text (each must end in white space) its sorted distinct ``width``-word shingles as 64-bit hashes.

    A text of fewer words is one shingle, one without words has none.
    """
    data, offsets = buffers(array)
    for first, last in pieces(data, offsets):
        words, starts = word_hashes(data[offsets[first] : offsets[last]])
        ends = np.searchsorted(starts, offsets[first + 1 : last + 1] - offsets[first])
        grams = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            grams += words[k : k + len(grams)] * _PLACE[k]
        grams, begin = mixed(grams), 0
        for end in ends:
            if end - begin >= width:
                yield np.unique(grams[begin : end - width + 1])
            elif end > begin:
                short = (words[begin:end] * _PLACE[: end - begin]).sum(dtype=np.uint64) + np.uint64(end - begin)
                yield mixed(np.array([short ^ _WORD], np.uint64))
            else:
                yield np.zeros(0, np.uint64)
            begin = end


# -- connected components ----------------------------------------------------------------------------------------


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the given edges with the smallest node that these edges connect it to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    up = list(range(len(nodes)))

    def top(x: int) -> int:
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    half = len(a)
    for x, y in zip(ends[:half].tolist(), ends[half:].tolist(), strict=True):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return nodes, nodes[[top(x) for x in range(len(nodes))]]


def _contracted(batches):
    """A star for each component that a run of edges forms: as many edges as nodes at most."""
    for batch in batches:
        node, root = _roots(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        other = node != root
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(root[other])], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` of every node of ``edges`` (``a``, ``b`` long, not null): the smallest node reachable.

    Runs of edges are contracted inside the tasks. Then, in rounds, every node takes its smallest neighbour as its parent,
    chains of parents are followed to their ends by doubling, and edges are rewritten to these ends, until no edge is
    left. The number of rounds grows with the logarithm of the longest chain; hubs only meet minima (combined
    before the shuffle) and plain joins, which adaptive execution splits.
    """
    edges = written(edges.filter("a <> b").select("a", "b").mapInArrow(_contracted, "a long, b long"))
    label = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("p")).withColumnRenamed("a", "node"))
        while True:
            above = parent.select(F.col("node").alias("p"), F.col("p").alias("q"))
            jumped = written(parent.join(above, "p", "left").select("node", F.coalesce("q", "p").alias("q"), "p"))
            moved = not jumped.filter("p <> q").isEmpty()
            parent = jumped.select("node", F.col("q").alias("p"))
            if not moved:
                break
        if label is None:
            label = parent
        else:
            nxt = parent.select(F.col("node").alias("p"), F.col("p").alias("q"))
            label = written(label.join(nxt, "p", "left").select("node", F.coalesce("q", "p").alias("p")))
        of_a = parent.select(F.col("node").alias("a"), F.col("p").alias("x"))
        of_b = parent.select(F.col("node").alias("b"), F.col("p").alias("y"))
        edges = written(
            edges.join(of_a, "a").join(of_b, "b").filter("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b")).distinct().mapInArrow(_contracted, "a long, b long")
        )
    if label is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return label.select("node", F.col("p").alias("component"))
