"""Exact similarity join on word shingles: links of Jaccard similarity 0.75 or more, and the groups they form.

**Method.** Prefix filtering under several global token orders. Two sets of sizes ``m`` and ``n`` that reach the threshold share a token among
the first ``n - ceil(0.75 n) + 1`` of each set, under whatever order all tokens are put in. Each order puts tokens seen in many
documents last, the most frequent ones at the very end, and shuffles the others by its own hash. Texts with equal sets form one class; only classes are compared.

1. One pass writes each document's set size and 128-bit set fingerprint, and 32 bits of all tokens. These are dealt by value and counted over
   all tasks, so a token is frequent by the number of its documents, however many others there are.
2. One pass emits prefix tokens of each order as packed blocks, dealt by token, a class once per task.
3. Each bucket is sorted by token. Groups of up to ``small_group`` classes give pairs. Larger groups are named by their smallest
   class, groups of one name are joined, and each gives one row per member. A pair found under the first order stays only if every other order has it as well, or may have it in a large group.
4. Pairs that sizes and parity sketches of the sets (512 bits, then a bit for each token) do not rule out are verified on their whole
   texts, which are fetched for these pairs only.
5. Large groups are mostly copies of one another: their members are verified against one of them (the one with the fewest tokens of its
   own), components are formed, then one member of each remaining component against another, until nothing new links. Pairs of
   members that are still in different components then go through step 4, so that no link is lost.

Frequencies only choose the order, so missing one costs time, never a link. Nothing is capped.

**Cases.** A text of 1 to 4 words is a single shingle; null and empty texts, and those without words, link with nothing.
Repeated rows and ids are kept, one result each. The component of a null ``doc_id`` is the smallest id of its group (null if it has none). Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blank_if_null, bounded_batches, components, give_back, mixed, shingle_sets, sized
from tidemark.operators.scratch import written

#: 100 * |A and B| >= PERCENT * |A or B|
PERCENT = 75
#: Tokens of more classes than this are frequent (a class counts once per task); of more than so many, only the most frequent ones are told to the tasks.
FREQUENT, FREQUENT_KEPT = 8, 200_000
#: Tokens that a task holds before it writes them; runs that they are cut into, by their first bits.
HELD, SLICE_BITS = 1 << 21, 12
#: Prefix tokens of one order that a bucket holds, about.
BUCKET_BYTES = 6 << 20
_SEEDS = np.random.default_rng(9).integers(1, 1 << 63, 16, dtype=np.uint64)
_TOKEN_BITS = np.uint64((1 << 48) - 1)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    one, two = mixed(s).sum(dtype=np.uint64), mixed(s ^ _SEEDS[-1]).sum(dtype=np.uint64)
    return int(np.int64(one.view(np.int64))), int(np.int64(two.view(np.int64)))


def _prefix_length(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def _batches(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _texts(docs: DataFrame, *columns: str) -> DataFrame:
    """Texts end in a blank, as ``shingle_sets`` wants them."""
    return docs.select(*columns, F.concat(blank_if_null(), F.lit(" ")).alias("text"))


# -- 1 and 2: signatures and prefixes ----------------------------------------------------------------------------

SKETCH = 8  # longs
SIGNATURE = "doc_id long, n long, f1 long, f2 long, slice int, step int, tokens binary, " + ", ".join(f"s{i} long" for i in range(SKETCH))


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of tokens that fall on each bit. Each token that only one of two sets has flips one bit, so the
    sketches of two sets differ in no more bits than the sets in tokens."""
    bits = np.bincount((mixed(s ^ _SEEDS[-2]) & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _may_link(x: str, y: str) -> Column:
    """False only if sizes or sketches rule a link out: sets that link differ in at most a seventh of their summed sizes."""
    n, m = F.col(f"n_{x}"), F.col(f"n_{y}")
    differ = sum((F.bit_count(F.col(f"s{i}_{x}").bitwiseXOR(F.col(f"s{i}_{y}"))) for i in range(SKETCH)), F.lit(0))
    sizes = 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)
    return sizes & ((100 + PERCENT) * differ <= (100 - PERCENT) * (n + m))


def _short(s: np.ndarray) -> np.ndarray:
    """First half of each token, by which tokens are counted: others that share it add to the count, which costs time, never a link."""
    return (s >> np.uint64(32)).astype(np.uint32)


def _sliced(tokens: np.ndarray) -> tuple[np.ndarray, int, list[bytes]]:
    """Slices of short tokens that have any, bytes of a step, steps of each slice: from its lower bound to its first token, then from token to token."""
    tokens = np.sort(tokens)
    of = tokens >> np.uint32(32 - SLICE_BITS)
    start = np.flatnonzero(np.diff(of, prepend=of[:1] + np.uint32(1)))
    steps = np.diff(tokens, prepend=tokens[:1])
    steps[start] = tokens[start] & np.uint32((1 << (32 - SLICE_BITS)) - 1)
    steps = steps.astype(np.uint16) if steps.max() < 1 << 16 else steps
    return of[start].astype(np.int32), steps.itemsize, [part.tobytes() for part in np.split(steps, start[1:])]


def _counted(pdf: pd.DataFrame) -> pd.DataFrame:
    """Frequent ones of the short tokens of some slices, with the number of times each was written."""
    give_back()  # what the slices before took
    steps = {2: np.uint16, 4: np.uint32}
    rows = zip(pdf["slice"], pdf["step"], pdf["tokens"], strict=True)
    tokens = [np.cumsum(np.frombuffer(t, steps[w]), dtype=np.uint32) + np.uint32(k << (32 - SLICE_BITS)) for k, w, t in rows]
    tokens, seen = np.unique(np.concatenate(tokens), return_counts=True)
    often = seen > FREQUENT
    return pd.DataFrame({"token": tokens[often].astype(np.int64), "seen": seen[often]})


def _signatures(width: int):
    names = ["doc_id", "n", "f1", "f2", "slice", "step", "tokens", *(f"s{i}" for i in range(SKETCH))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, known = [], 0, set()

        def told():
            of, step, tokens = _sliced(np.concatenate(held))
            none, steps = pa.nulls(len(of), pa.int64()), pa.array(np.full(len(of), step, np.int32))
            return pa.RecordBatch.from_arrays([none, none, none, none, pa.array(of), steps, pa.array(tokens, pa.binary()), *[none] * SKETCH], names=names)

        for batch in batches:
            n, marks, sketches = [], [], []
            for s in shingle_sets(batch.column("text"), width):
                n.append(len(s))
                marks.append(_fingerprint(s))
                sketches.append(_sketch(s))
                if len(s) and marks[-1] not in known:
                    known.add(marks[-1])
                    held.append(_short(s))
                    size += len(s)
                if size > HELD:
                    yield told()
                    held, size = [], 0
                    give_back()
            none = [pa.nulls(len(n), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            one, two = (pa.array([m[i] for m in marks], pa.int64()) for i in (0, 1))
            bits = [pa.array(b) for b in np.array(sketches, np.int64).reshape(-1, SKETCH).T]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), one, two, *none, *bits], names=names)
        if held:
            yield told()
        held, known = [], set()
        give_back()

    return run


def signatures(docs: DataFrame, width: int = 5) -> tuple[DataFrame, tuple[np.ndarray, np.ndarray]]:
    """Set size and fingerprint of every row; frequent short tokens, sorted, with their level (higher: more classes)."""
    rows = _texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    out = written(rows.mapInArrow(_signatures(width), SIGNATURE))
    total = out.agg(F.sum("n")).first()[0] or 0
    parts = min(1 << SLICE_BITS, max(64, total * 4 // (2 * BUCKET_BYTES)))
    told = out.filter("n IS NULL").select("slice", "step", "tokens", F.shiftright(F.col("slice") * parts, SLICE_BITS).alias("part"))
    often = told.groupBy("part").applyInPandas(_counted, "token long, seen long")
    often = written(often.withColumn("level", F.floor(4 * F.log2("seen")).cast("int")))
    least, many = 256, 0
    for level, rows in often.groupBy("level").count().orderBy(F.desc("level")).collect():
        many += rows
        if many > FREQUENT_KEPT:
            break
        least = level
    often = often.filter(F.col("level") >= least).select("token", "level").toPandas().sort_values("token")
    often = often["token"].to_numpy(np.uint32), often["level"].to_numpy(np.uint8)
    return out.filter("n IS NOT NULL").drop("slice", "step", "tokens"), often


def _late(s: np.ndarray, often: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Level of each token in the first byte, 0 if it is not frequent."""
    late = np.zeros(len(s), np.uint64)
    if len(often):
        short = _short(s)
        at = np.minimum(np.searchsorted(often, short), len(often) - 1)
        hit = often[at] == short
        late[hit] = level[at[hit]].astype(np.uint64) << np.uint64(56)
    return late


def _prefixes(width: int, orders: int, buckets: int, often: tuple[np.ndarray, np.ndarray]):
    """Rows of (part, entries, classes): entries are ``token << 16 | number of the class in classes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, entries, size, known = [], [[] for _ in range(orders)], 0, set()

        def flushed():
            rows = np.array(table, np.int64)
            parts, blobs, tables = [], [], []
            for k in range(orders):
                e = np.concatenate(entries[k])
                bucket = (e >> np.uint64(16)) % np.uint64(buckets)
                e = e[np.argsort(bucket, kind="stable")]
                ends = np.cumsum(np.bincount(bucket.astype(np.int64), minlength=buckets))
                for b in range(buckets):
                    mine = e[ends[b - 1] if b else 0 : ends[b]]
                    if len(mine):
                        used, new = np.unique(mine & np.uint64(0xFFFF), return_inverse=True)
                        mine = np.sort((mine & ~np.uint64(0xFFFF)) | new.astype(np.uint64))
                        parts.append(k * buckets + b)
                        blobs.append(mine.tobytes())
                        tables.append(rows[used.astype(np.int64)].tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.int32()), pa.array(blobs, pa.binary()), pa.array(tables, pa.binary())],
                names=["part", "entries", "classes"],
            )

        give_back()
        for batch in batches:
            for s in shingle_sets(batch.column("text"), width):
                mark = _fingerprint(s)
                if not len(s) or mark in known:
                    continue
                known.add(mark)
                p = _prefix_length(len(s))
                late = _late(s, *often)
                for k in range(orders):
                    key = mixed(s ^ _SEEDS[k])
                    first = np.argpartition((key >> np.uint64(8)) | late, p - 1)[:p] if p < len(s) else slice(None)
                    entries[k].append(((key[first] & _TOKEN_BITS) << np.uint64(16)) | np.uint64(len(table)))
                table.append(mark[0])
                size += p
                if len(table) == 1 << 16 or size > 1 << 19:
                    yield flushed()
                    table, entries, size = [], [[] for _ in range(orders)], 0
                    give_back()
        if table:
            yield flushed()
        table, entries, known = [], [], set()
        give_back()

    return run


# -- 3: pairs from buckets ---------------------------------------------------------------------------------------

FOUND = "order int, a long, b long, head long, tokens long"


def _found(buckets: int, small_group: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        give_back()  # what the bucket before took
        order = int(key[0]) // buckets
        entries, docs, base = [], [], 0
        for blob, table in zip(pdf["entries"], pdf["classes"], strict=True):
            e = np.frombuffer(blob, np.uint64)
            t = np.frombuffer(table, np.int64)
            entries.append((e >> np.uint64(16), (e & np.uint64(0xFFFF)).astype(np.int64) + base))
            docs.append(t)
            base += len(t)
        docs, which = np.unique(np.concatenate(docs), return_inverse=True)  # a class may come from many tasks
        token, doc = np.concatenate([e[0] for e in entries]), which[np.concatenate([e[1] for e in entries])]
        at = np.lexsort((doc, token))
        token, doc = token[at], doc[at]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
        token, doc = token[fresh], doc[fresh]
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(start, len(token)))
        pairs = []
        for g in np.unique(count[(count > 1) & (count <= small_group)]):
            rows = doc[start[count == g][:, None] + np.arange(g)]
            x, y = np.triu_indices(g, 1)
            pairs.append(np.unique(rows[:, x].reshape(-1) * len(docs) + rows[:, y].reshape(-1)))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        a, b = docs[pairs // len(docs)], docs[pairs % len(docs)]
        # A large group is named by its smallest class; groups of the same name are one from here on.
        large = count > small_group
        head, member = np.repeat(doc[start[large]], count[large]), doc[np.repeat(large, count)]
        told, tokens = np.unique(head * len(docs) + member if order == 0 else member, return_counts=True)
        head, member = docs[told // len(docs)] if order == 0 else np.zeros(len(told), np.int64), docs[told % len(docs)]
        both = len(a) + len(member)
        return pd.DataFrame({
            "order": np.full(both, order, np.int32), "a": np.concatenate([a, member]), "b": np.concatenate([b, member]),
            "head": pd.arrays.IntegerArray(np.concatenate([a, head]), np.arange(both) < len(a)),
            "tokens": np.concatenate([np.zeros(len(a), np.int64), tokens]),
        })

    return run


# -- 4: verification ---------------------------------------------------------------------------------------------


def _verified(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, np.ndarray] = {}

        def sets(batch, node, text):
            """Sets by node; the texts of a node that came before are not read again."""
            nodes = batch.column(node).to_pylist()
            new = [i for i, n in enumerate(nodes) if n not in recent and n not in nodes[:i]] if len(nodes) < 64 else list(range(len(nodes)))
            took = batch.column(text).take(pa.array(new, pa.int32()))
            found = dict(zip((nodes[i] for i in new), shingle_sets(took, width), strict=True))
            return [found[n] if n in found else recent[n] for n in nodes]

        for whole in batches:
            for batch in _batches(whole, 48):
                left, right = sets(batch, "a", "text_a"), sets(batch, "b", "text_b")
                recent = dict(list(zip(batch.column("a").to_pylist(), left, strict=True))[-1:])
                keep = []
                for x, y in zip(left, right, strict=True):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
        recent.clear()
        give_back()

    return run


def _wide_sketch(s: np.ndarray) -> bytes:
    """As ``_sketch`` with at least a bit for each token (a power of two, from 4096), for large sets."""
    width = max(4096, 1 << (len(s) - 1).bit_length())
    bits = np.bincount((mixed(s ^ _SEEDS[-3]) & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _differing(x: bytes, y: bytes) -> int:
    """Bits in which two wide sketches differ; the wider is folded to the width of the other (a parity of parities)."""
    x, y = (np.frombuffer(v, np.uint64) for v in ((x, y) if len(x) <= len(y) else (y, x)))
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sieved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = zip(batch.column("w_a").to_pylist(), batch.column("w_b").to_pylist(), strict=True)
        differ = np.fromiter((_differing(x, y) for x, y in both), np.int64, batch.num_rows)
        sizes = batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()
        may = (100 + PERCENT) * differ <= (100 - PERCENT) * sizes
        yield batch.select(["a", "b"]).filter(pa.array(may, pa.bool_()))


def _looked_up(docs: DataFrame, nodes: DataFrame, width: int, what: str) -> DataFrame:
    """``node`` and ``what`` of ``nodes`` (a written table of ``node, f1, f2, doc_id``): looked up by id, told apart from other rows of that id by fingerprint."""
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    rows = _texts(docs, F.col("doc_id").cast("long").alias("_id")).join(sized(nodes), same).select("node", "f1", "f2", "text")
    return written(rows.mapInArrow(_matching(width, what), f"node long, {_LOOKED_UP[what]}").dropDuplicates(["node"]))


def _verify(pairs: DataFrame, docs: DataFrame, wanted: DataFrame, sketches: DataFrame, width: int) -> DataFrame:
    """Those of ``pairs`` (``a``, ``b``) that link: by wide sketches first, then by texts, which only pairs that are left fetch.

    A node in many pairs is ``a``: adaptive execution splits it.
    """
    wide = lambda x: sketches.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("wide").alias(f"w_{x}"))
    pairs = written(pairs.join(wide("b"), "b").join(wide("a"), "a").select("a", "b", "n_a", "n_b", "w_a", "w_b").mapInArrow(_sieved, "a long, b long"))
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    texts = _looked_up(docs, written(wanted.join(needed, "node", "left_semi")), width, "text")
    of_b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    of_a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    return written(pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verified(width), "a long, b long"))


# -- the whole ---------------------------------------------------------------------------------------------------


def similar_documents(docs: DataFrame, width: int = 5, orders: int = 2, small_group: int = 8) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (``doc_id``, ``text``)."""
    bounded_batches(docs.sparkSession)
    signature, often = signatures(docs, width)
    sketch = [F.any_value(f"s{i}").alias(f"s{i}") for i in range(SKETCH)]
    classes = signature.filter("n > 0").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("least"), *sketch)
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()))
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(16, int(total * (1 - PERCENT / 100) * 8 / BUCKET_BYTES))
    blocks = _texts(docs).mapInArrow(_prefixes(width, orders, buckets, often), "part int, entries binary, classes binary")
    found = written(blocks.groupBy("part").applyInPandas(_found(buckets, small_group), FOUND))

    # Pairs that every order allows (in a large group of an order, every pair of members is allowed), then sizes and sketches.
    # Classes are named by half of their fingerprint up to here; where two share it, both go on.
    member = found.filter("head IS NOT NULL")
    in_large = member.groupBy("a").agg(F.expr("bit_or(shiftleft(1, order))").alias("large"))
    flags = lambda x: in_large.select(F.col("a").alias(x), F.col("large").alias(f"large_{x}"))
    pairs = found.filter("head IS NULL").groupBy("a", "b").agg(F.expr("bit_or(shiftleft(1, order))").alias("orders"))
    either = F.coalesce(F.col("large_a").bitwiseAND(F.col("large_b")), F.lit(0))
    pairs = pairs.filter(F.col("orders").bitwiseAND(1) == 1).join(flags("a"), "a", "left").join(flags("b"), "b", "left")
    pairs = pairs.filter(F.col("orders").bitwiseOR(either) == F.lit((1 << orders) - 1)).select(F.col("a").alias("f_a"), F.col("b").alias("f_b"))
    detail = ["node", "n", *(f"s{i}" for i in range(SKETCH))]
    of = lambda x, *keys: classes.select(F.col("f1").alias(f"f_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in detail))
    pairs = pairs.join(of("a"), "f_a").join(of("b"), "f_b").filter(_may_link("a", "b"))
    pairs = written(pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")))

    # Members of large groups; ``part`` is the share of a class's prefix that lies in large groups, most for the common ancestor of copies.
    share = F.col("tokens") / (F.col("n") - F.ceil(PERCENT * F.col("n") / 100) + 1)
    weight = member.filter("order = 0").groupBy("a").agg(F.sum("tokens").alias("tokens")).join(classes, F.col("a") == F.col("f1"))
    weight = written(weight.select("a", share.alias("part"), *detail))
    member = written(member.filter("order = 0").select(F.col("head").alias("token"), "a").distinct().join(sized(weight.select("a", "node", "part")), "a").select("token", "node", "part"))
    first = F.max_by("node", F.struct("part", -F.col("node")))  # of some members, the one to compare the others with

    # Wide sketches of all nodes that may be compared.
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(weight.select("node")).distinct()
    wanted = written(classes.join(wanted, "node", "left_semi").select("node", "f1", "f2", F.col("least").alias("doc_id")))
    sketches = _looked_up(docs, wanted, width, "sketch")
    verify = lambda p: _verify(p, docs, wanted, sketches, width)

    flat = weight.select(*(F.col(c) for c in detail))
    side = lambda x: flat.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in detail if c != "node"))
    possible = lambda p: p.join(sized(side("a")), "a").join(sized(side("b")), "b").filter(_may_link("a", "b")).select("a", "b")
    star = member.join(member.groupBy("token").agg(first.alias("c")), "token").filter("node <> c")
    star = possible(star.select(F.col("c").alias("a"), F.col("node").alias("b")).distinct())
    tried = written(pairs.union(star).distinct())
    links = verify(tried)
    group = components(links)
    while not member.isEmpty():
        placed = member.join(sized(group), "node", "left").select("token", "part", "node", F.coalesce("component", "node").alias("c"))
        several = placed.groupBy("token").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("token")
        placed = written(placed.join(several, "token", "left_semi"))  # groups that are not yet one component
        heads = placed.groupBy("token", "c").agg(first.alias("node"), F.max("part").alias("part"))
        more = heads.join(heads.groupBy("token").agg(first.alias("a")), "token").filter("node <> a")
        more = possible(more.select("a", F.col("node").alias("b")).distinct())
        more = written(more.join(tried, ["a", "b"], "left_anti"))
        fresh = None if more.isEmpty() else verify(more)
        tried = written(tried.union(more))
        if fresh is None or fresh.isEmpty():
            break
        links = written(links.union(fresh))
        group = components(links)
    if not member.isEmpty():
        # What no shortcut joined: members of different components, pair by pair, if sizes and sketches allow a link.
        placed = placed.select("token", "node", "c").join(sized(flat), "node")
        left, right = (placed.select("token", F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ["c", *detail[1:]])) for x in "ab")
        near = (left.token == right.token) & (F.col("c_a") != F.col("c_b")) & (F.col("a") < F.col("b")) & _may_link("a", "b")
        rest = written(left.join(right, near).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"))
        if not rest.isEmpty():
            group = components(written(links.union(verify(rest))))

    # Smallest id of each component, told to every class, then to every row.
    placed = classes.join(group, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = placed.groupBy("c").agg(F.min("least").alias("component_id"))
    named = written(placed.join(least, "c").select("f1", "f2", F.col("n").alias("_n"), "component_id"))
    own = signature.withColumn("f1", F.when(F.col("n") > 0, F.col("f1")))  # rows without words meet nothing
    out = own.join(sized(named), (own.f1 == named.f1) & (own.f2 == named.f2) & (own.n == named._n), "left")
    alone = F.when(F.col("n") == 0, F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", alone).alias("component_id"))


_LOOKED_UP = {"sketch": "n long, wide binary", "text": "text string"}


def _matching(width: int, what: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = zip(batch.column("f1").to_pylist(), batch.column("f2").to_pylist(), strict=True)
            keep, n, wide = [], [], []
            for mark, s in zip(marks, shingle_sets(batch.column("text"), width), strict=True):
                keep.append(mark == _fingerprint(s))
                if what == "sketch":
                    n.append(len(s))
                    wide.append(_wide_sketch(s))
            more = {"text": batch.column("text")} if what == "text" else {"n": pa.array(n, pa.int64()), "wide": pa.array(wide, pa.binary())}
            yield pa.RecordBatch.from_arrays([batch.column("node"), *more.values()], names=["node", *more]).filter(pa.array(keep, pa.bool_()))
        give_back()

    return run
