"""Ranked lexical search: an inverted index in shards of documents, searched by Block-Max MaxScore.

``write_index`` reads every text once, without a shuffle. A task cuts its rows into shards of about ``SHARD_BYTES`` of text and
writes a row for each (shard, term): the postings (document numbers within the shard as gaps, and occurrences, as
variable-length bytes), and, for each block of ``BLOCK`` postings, its last document, the most occurrences, the shortest document
and where it begins. A further row (``term`` null) has the shard's ids and lengths. What a posting can score at most
follows from the last two of these once the corpus totals are known, so an index can be joined by later ones.

``search`` deals whole shards to tasks and, in each, goes through windows of documents, query by query. Lists are ordered by what
they can add at most; those at the low end that together stay below the k-th best score so far are non-essential: documents that
only they hold cannot enter. The essential ones are decoded and summed. A candidate is then rejected without decoding a
non-essential list if its sum and the maxima of the blocks it falls into stay below the k-th best score; for the others blocks
are decoded, list by list, with the same test after each. A task keeps its heaps from shard to shard; the heaps of all tasks,
k rows for each query, are merged by a window. Scores equal to the k-th best are never rejected, so ties end exactly.

Cases: null and empty texts have no term, count nowhere and are never found; a text of any length is one document; null ids rank after
others of equal score; rows of equal ids are documents of their own; repeated items are queries of their own; items without terms find
nothing; an empty corpus or query table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import _BYTE_VALUES, _power, blank_if_null, bounded_batches, buffers, mixed, sized
from tidemark.operators.scratch import scratch_path, written

#: Fixed value: what a term is made of. Its bytes are those above 0x7F, digits and letters.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 128
#: Text of a shard. A task holds about 20 times as much while it builds one.
SHARD_BYTES = 8 << 20
#: Documents of a shard that are summed at a time.
WINDOW = 1024
#: Queries that are searched for in one pass over the index.
QUERIES = 256

INDEX = (
    "shard long, term string, df int, max_tf int, min_n int, blocks binary, payload binary, ids array<long>, docs long, tokens long"
)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLDED = np.arange(256, dtype=np.uint8)
_FOLDED[0x41:0x5B] += 0x20


# -- building ----------------------------------------------------------------------------------------------------


def tokens(data: np.ndarray, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of every term of a buffer whose texts are set apart by a byte outside terms."""
    found, at = [], 0
    while at < len(data):
        end = min(len(data), at + step)
        while end < len(data) and _INSIDE[data[end - 1]] and _INSIDE[data[end]]:  # not inside a term
            outside = np.flatnonzero(~_INSIDE[data[end : end + step]])
            end = end + int(outside[0]) if len(outside) else min(len(data), end + step)
        part = data[at:end]
        inside = np.zeros(len(part) + 2, np.int8)
        inside[1:-1] = _INSIDE[part]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        power, inverse = _power(max(step, len(part)))
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[part] * power[: len(part)], out=total[1:])
        found.append((mixed((total[last] - total[first]) * inverse[first]), first + at, last + at))
        at = end
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def varbytes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the lowest first, and where each begins (and the last ends)."""
    width = 1 + sum((values >= 1 << 7 * k).astype(np.int64) for k in range(1, 5))
    at = np.zeros(len(values) + 1, np.int64)
    np.cumsum(width, out=at[1:])
    out = np.zeros(at[-1], np.uint8)
    for k in range(int(width.max(initial=0))):
        has = width > k
        out[at[:-1][has] + k] = (values[has] >> 7 * k & 127) | (width[has] > k + 1) * 128
    return out, at


def numbers(data: np.ndarray) -> np.ndarray:
    """The inverse of ``varbytes``."""
    ends = np.flatnonzero(data < 128)
    if len(ends) == len(data):
        return data.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    shift = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << 7 * shift, starts)


def _binary(data: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])


def _gathered(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.zeros(len(first) + 1, np.int64)
    np.cumsum(length, out=at[1:])
    return data[np.arange(at[-1]) + np.repeat(first - at[:-1], length)], at


def shard_rows(shard: int, ids: list, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The rows of one shard: its documents', then one for each term."""
    hashes, first, last = tokens(data)
    doc = np.searchsorted(offsets, first, "right") - 1
    count = len(offsets) - 1
    n = np.bincount(doc, minlength=count).astype(np.int32)
    _, example, term = np.unique(hashes, return_index=True, return_inverse=True)
    posting, tf = np.unique(term.astype(np.int64) * count + doc, return_counts=True)
    term, doc = posting // count, posting % count
    start = np.flatnonzero(np.diff(term, prepend=-1))
    df = np.diff(start, append=len(term))
    gap = np.diff(doc, prepend=0) - 1
    gap[start] = doc[start]
    coded, at = varbytes(np.stack([gap, tf - 1], 1).ravel())
    lists = at[np.append(2 * start, 2 * len(term))]

    # Blocks, of lists that have several.
    long = np.flatnonzero(df > BLOCK)
    per_list = -(-df[long] // BLOCK)
    begin = np.repeat(start[long], per_list) + BLOCK * (np.arange(per_list.sum()) - np.repeat(np.cumsum(per_list) - per_list, per_list))
    end = np.minimum(begin + BLOCK, np.repeat(start[long] + df[long], per_list))
    head = [np.zeros(0, np.int32)] * 4
    if len(begin):
        both = np.stack([begin, end], 1).ravel()
        both, odd = (both[:-1], None) if both[-1] == len(term) else (both, None)
        head = [doc[end - 1], np.maximum.reduceat(tf, both)[::2], np.minimum.reduceat(n[doc], both)[::2], at[2 * begin] - np.repeat(at[2 * start[long]], per_list)]
    block_at = np.zeros(len(df) + 1, np.int64)
    block_at[1:][long] = 16 * per_list
    np.cumsum(block_at, out=block_at)
    by_list = np.repeat(np.arange(len(long)), per_list)
    order = np.lexsort((np.tile(np.arange(len(begin)), 4), np.repeat(np.arange(4), len(begin)), np.tile(by_list, 4)))
    blocks = np.concatenate(head).astype("<i4")[order].view(np.uint8)

    name, name_at = _gathered(_FOLDED[data], first[example], (last - first)[example])
    rows = len(df) + 1
    none = lambda kind: pa.nulls(len(df), kind)
    joined = lambda one, rest: pa.concat_arrays([one, rest])
    most, least = (f.reduceat(x, start) if len(start) else x for f, x in ((np.maximum, tf), (np.minimum, n[doc])))
    columns = {
        "shard": pa.array(np.full(rows, shard)),
        "term": joined(pa.nulls(1, pa.string()), _binary(name, name_at, pa.string())),
        "df": joined(pa.nulls(1, pa.int32()), pa.array(df.astype(np.int32))),
        "max_tf": joined(pa.nulls(1, pa.int32()), pa.array(most.astype(np.int32))),
        "min_n": joined(pa.nulls(1, pa.int32()), pa.array(least.astype(np.int32))),
        "blocks": joined(pa.nulls(1, pa.binary()), _binary(blocks, block_at, pa.binary())),
        "payload": joined(pa.array([n.astype("<i4").tobytes()], pa.binary()), _binary(coded, lists, pa.binary())),
        "ids": joined(pa.array([ids], pa.list_(pa.int64())), none(pa.list_(pa.int64()))),
        "docs": joined(pa.array([int((n > 0).sum())], pa.int64()), none(pa.int64())),
        "tokens": joined(pa.array([int(n.sum())], pa.int64()), none(pa.int64())),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _indexed(shard_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, parts, held = TaskContext.get().partitionId() << 24, [], [], 0

        def closed() -> pa.RecordBatch:
            data = np.concatenate([d for d, _ in parts])
            sizes = np.concatenate([np.diff(o) for _, o in parts])
            return shard_rows(shard, ids, data, np.concatenate([[0], np.cumsum(sizes)]))

        for batch in batches:
            data, offsets = buffers(batch.column(1))
            own, at = batch.column(0).to_pylist(), 0
            while at < len(own):
                # As many rows as the shard still takes, one at least.
                end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + shard_bytes - held, "right")) - 1)
                end = min(end, len(own))
                parts.append((data[offsets[at] : offsets[end]].copy(), offsets[at : end + 1].copy()))
                ids += own[at:end]
                held += int(offsets[end] - offsets[at])
                at = end
                if held >= shard_bytes or end < len(own):
                    yield closed()
                    shard, ids, parts, held = shard + 1, [], [], 0
        if ids:
            yield closed()

    return run


def write_index(docs: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the index of all ``docs`` (``doc_id``, ``text``) as a table."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.concat(blank_if_null(), F.lit("\n")).alias("text"))
    rows.mapInArrow(_indexed(shard_bytes), INDEX).write.parquet(path)


# -- searching ---------------------------------------------------------------------------------------------------


def _impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Totals:
    """What scores depend on besides the document: ``docs`` with a term, and all ``tokens`` of the corpus."""

    def __init__(self, docs: int, tokens: int):
        self.docs, self.tokens = docs, tokens

    def m(self, n: np.ndarray) -> np.ndarray:
        return 75 + 25 * n.astype(np.int64) * self.docs // self.tokens


class Postings:
    """One term's list in a shard: bounds first, postings when they are asked for."""

    def __init__(self, df: int, max_tf: int, min_n: int, blocks: bytes | None, payload: bytes, shard: "Shard"):
        self.shard, self.data, self._decoded = shard, np.frombuffer(payload, np.uint8), {}
        if blocks:
            head = np.frombuffer(blocks, "<i4").astype(np.int64).reshape(4, -1)
            self.last, self.at = head[0], np.append(head[3], len(self.data))
            self.most = _impact(head[1], shard.totals.m(head[2]))
        else:
            self.last, self.at = np.array([len(shard.m) - 1]), np.array([0, len(self.data)])
            self.most = _impact(np.array([max_tf]), shard.totals.m(np.array([min_n])))
        self.bound = int(self.most.max())
        #: What block maxima say of a document past the last one.
        self.most_at = np.append(self.most, 0)

    def decode(self, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of blocks ``first`` to ``end``."""
        if (first, end) not in self._decoded:
            self.shard.decoded += end - first
            pairs = numbers(self.data[self.at[first] : self.at[end]])
            doc = np.cumsum(pairs[::2] + 1) + (self.last[first - 1] if first else -1)
            self._decoded[first, end] = doc, _impact(pairs[1::2] + 1, self.shard.m[doc])
        return self._decoded[first, end]

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` to ``high`` (exclusive) and their impacts."""
        first = int(np.searchsorted(self.last, low))
        end = min(int(np.searchsorted(self.last, high - 1)) + 1, len(self.last))
        if first >= end:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        doc, impact = self.decode(first, end)
        a, b = np.searchsorted(doc, [low, high])
        return doc[a:b], impact[a:b]

    def block_of(self, doc: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.last, doc)

    def impacts(self, doc: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Impacts of single documents, by the blocks that they fall into; others are not decoded."""
        out = np.zeros(len(doc), np.int64)
        for b in np.unique(block[block < len(self.last)]):
            here = np.flatnonzero(block == b)
            own, impact = self.decode(int(b), int(b) + 1)
            at = np.minimum(np.searchsorted(own, doc[here]), len(own) - 1)
            out[here] = np.where(own[at] == doc[here], impact[at], 0)
        return out


class Shard:
    def __init__(self, n: np.ndarray, ids: list, totals: Totals):
        self.totals, self.m, self.ids, self.lists, self.decoded = totals, totals.m(n), ids, {}, 0


class Best:
    """The k best rows so far of one query: highest score first, then smallest id, null ids last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def least(self) -> int:
        """Scores below this cannot enter."""
        return self.rows[-1][0] if len(self.rows) == self.k else 1

    def add(self, scores: list[int], ids: list) -> None:
        found = [(s, i) for s, i in zip(scores, ids, strict=True) if s >= self.least]
        self.rows = sorted(self.rows + found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))[: self.k]


def search_shard(shard: Shard, weights: list[tuple[str, int]], best: Best, window: int = WINDOW) -> None:
    """Block-Max MaxScore of one query (its terms' weights, repeats included) over one shard."""
    lists = [(shard.lists[t], w) for t, w in weights if w > 0 and t in shard.lists]
    lists.sort(key=lambda x: x[0].bound * x[1])
    upto = np.cumsum([p.bound * w for p, w in lists])
    for low in range(0, len(shard.m), window):
        least = best.least
        others = int(np.searchsorted(upto, least))  # these lists together stay below the least score that enters
        if others == len(lists):
            return
        score, held = np.zeros(window, np.int64), np.zeros(window, bool)
        for postings, w in lists[others:]:
            doc, impact = postings.between(low, low + window)
            score[doc - low] += w * impact
            held[doc - low] = True
        doc = np.flatnonzero(held)
        score = score[doc]
        if others:
            near = score + upto[others - 1] >= least
            doc, score = doc[near], score[near]
            block = [p.block_of(doc + low) for p, _ in lists[:others]]
            most = [w * p.most_at[b] for (p, w), b in zip(lists, block)]
            rest = sum(most)
            for k in range(others - 1, -2, -1):
                near = score + rest >= least
                if not near.all():
                    doc, score, rest = doc[near], score[near], rest[near]
                    block, most = [b[near] for b in block], [x[near] for x in most]
                if k < 0 or not len(doc):
                    break
                postings, w = lists[k]
                score = score + w * postings.impacts(doc + low, block[k])
                rest = rest - most[k]
        enters = np.flatnonzero(score >= least)
        best.add(score[enters].tolist(), [shard.ids[low + d] for d in doc[enters].tolist()])


def _searched(weights: dict[int, list[tuple[str, int]]], totals: Totals, k: int):
    """Index rows in order of (shard, term), documents' row first, to each query's best rows of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, shard, number = {q: Best(k) for q in weights}, None, None

        def finish() -> None:
            if shard is not None:
                for q, terms in weights.items():
                    search_shard(shard, terms, best[q])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for row in batch.slice(at, 512).to_pylist():
                    if row["shard"] != number:
                        finish()
                        number, shard = row["shard"], Shard(np.frombuffer(row["payload"], "<i4"), row["ids"], totals)
                    else:
                        shard.lists[row["term"]] = Postings(row["df"], row["max_tf"], row["min_n"], row["blocks"], row["payload"], shard)
        finish()
        rows = [(q, doc_id, score) for q, own in best.items() for score, doc_id in own.rows]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], names=["q", "doc_id", "score"])

    return run


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def search(spark: SparkSession, path: str, items: DataFrame, k: int = 20, queries: int = QUERIES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each row of ``items`` (``item_id``, ``text``).

    Items are searched for in blocks of ``queries``: a pass over the index for each, with the block's terms and weights in
    the tasks' code.
    """
    bounded_batches(spark)
    index = spark.read.parquet(path)
    totals = index.filter("term IS NULL").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).first()
    docs, all_tokens = totals.docs or 0, totals.tokens or 0
    items = items.select("item_id", "text")
    numbered = written(items.withColumn("_id", F.monotonically_increasing_id()))
    asked = numbered.select("_id", "item_id", F.explode(_terms(F.col("text"))).alias("term")).groupBy("_id", "item_id", "term").agg(F.count(F.lit(1)).alias("times"))
    asked = written(asked)
    known = index.join(sized(written(asked.select("term").distinct())), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.log((F.lit(2.0) * docs + 2) / (2.0 * F.col("df") + 1)))
    asked = written(asked.join(sized(written(known)), "term").select("_id", "term", (weight * F.col("times")).alias("weight")))
    found = spark.createDataFrame([], "q long, doc_id long, score long")
    block: dict[int, list[tuple[str, int]]] = defaultdict(list)

    def searched() -> DataFrame:
        terms = spark.createDataFrame([(t,) for t in sorted({t for own in block.values() for t, _ in own})], "term string")
        lists = index.join(F.broadcast(terms), "term").unionByName(index.filter("term IS NULL"))
        dealt = lists.select("shard", "term", "df", "max_tf", "min_n", "blocks", "payload", "ids").repartition("shard").sortWithinPartitions("shard", "term")
        return written(dealt.mapInArrow(_searched(dict(block), Totals(docs, all_tokens), k), "q long, doc_id long, score long"))

    for row in asked.orderBy("_id").toLocalIterator():
        if row._id not in block and len(block) == queries:
            found = found.union(searched())
            block.clear()
        block[row._id].append((row.term, row.weight))
    if block and docs:
        found = found.union(searched())
    best = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    ranked = found.withColumn("rank", best).filter(F.col("rank") <= k)  # k rows of each task for a query
    names = numbered.select(F.col("_id").alias("q"), "item_id")
    return ranked.join(names, "q").select("item_id", "rank", "doc_id", "score")


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 20, path: str | None = None) -> DataFrame:
    """Index ``docs`` (in scratch unless ``path`` is given) and search it for ``items``."""
    spark = docs.sparkSession
    path = path or scratch_path(spark)
    write_index(docs, path)
    return search(spark, path, items, k)
