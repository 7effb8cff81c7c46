"""Merkle manifest of a corpus: a root over all documents, and for each document the proof that leads to it.

Leaves of a group (``source``) ascend by ``doc_id``; every ``FANOUT`` consecutive nodes become the hash of their digests, the last
run of a level may be shorter, until one node is left, the group's subroot. The subroots, by group, become the root in
the same way.

Work is dealt out in *chunks* of ``FANOUT ** CHUNK_LEVELS`` aligned leaves, whatever the size of a group. A chunk hashes its own
leaves up to one digest. Above that chunks exchange digests as in a butterfly: in round r the chunks whose subtrees are siblings
swap the digests of these subtrees, each with those at its own offset, and each hashes the parent for itself.
So after the last round every chunk holds the siblings on its way to the root, and nothing is handed down again. A round is one
shuffle of one small row for each chunk. Only chunks of digests are ever in one task, texts are hashed where they
are read.

Cases: null fields and null texts have a digest of their own (``-`` instead of length and value); null ids come first;
rows with equal ids are ordered by their digests; equal rows are equal leaves; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import bounded_batches, positions, sized
from tidemark.operators.scratch import scratch_path, written

#: Nodes that become one.
FANOUT = 3
#: Levels inside a chunk: 729 leaves, some 50 kB of digests and ids.
CHUNK_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows of upper paths (some kB each) that may be broadcast.
BROADCAST_PATHS = 20_000

PATH = "array<struct<place:int,siblings:array<string>>>"
CHUNKS = "source string, chunk long, size long, levels int, digest string, ids array<long>, leaves array<binary>, claimed array<binary>"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf(fields: Iterable[str] = FIELDS, **changed: Column) -> Column:
    """Digest of a row: each field as length in UTF-8 bytes, colon and value, or ``-`` if it is null."""
    parts = []
    for name in fields:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


# -- inside a chunk ----------------------------------------------------------------------------------------------


def _hash(digests: Iterable[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(leaves: list[str], above: int) -> list[list[str]]:
    """The leaves and ``above`` levels over them."""
    levels = [leaves]
    for _ in range(above):
        below = levels[-1]
        levels.append([_hash(below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return levels


def levels_in_chunk(size: int, chunk_levels: int) -> int:
    """Levels that a chunk hashes: up to the group's subroot if the group is one chunk, else as many as every chunk of it."""
    levels, nodes = 0, size
    while nodes > 1 and levels < chunk_levels:
        levels, nodes = levels + 1, -(-nodes // FANOUT)
    return levels


def _siblings(levels: list[list[str]], at: int) -> Iterator[tuple[int, list[str]]]:
    """Place in the run and the run's other nodes, level by level."""
    for nodes in levels[:-1]:
        place = at % FANOUT
        run = nodes[at - place : at - place + FANOUT]
        yield place, run[:place] + run[place + 1 :]
        at //= FANOUT


def fold(digest: str, path: Iterable[tuple[int, list[str]]]) -> str:
    """The root that a digest leads to along a path."""
    for place, others in path:
        digest = _hash([*others[:place], digest, *others[place:]])
    return digest


def _packed(chunk_levels: int):
    """Rows in order of (source, chunk, place) to one row for each chunk."""
    schema = pa.schema([
        ("source", pa.string()), ("chunk", pa.int64()), ("size", pa.int64()), ("levels", pa.int32()), ("digest", pa.string()),
        ("ids", pa.list_(pa.int64())), ("leaves", pa.list_(pa.binary())), ("claimed", pa.list_(pa.binary())),
    ])

    def row(key: tuple, rows: list[tuple]) -> dict:
        source, chunk, size = key
        ids, leaves, claimed = (list(x) for x in zip(*rows, strict=True))
        levels = levels_in_chunk(size, chunk_levels)
        digest = levels_of([x.hex() for x in leaves], levels)[-1][0]
        return {"source": source, "chunk": chunk, "size": size, "levels": levels, "digest": digest, "ids": ids, "leaves": leaves, "claimed": claimed}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, done = None, [], []
        for batch in batches:
            for source, chunk, size, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and key != (source, chunk, size):
                    done.append(row(key, rows))
                    rows = []
                key = (source, chunk, size)
                rows.append(tuple(rest))
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if rows:
            yield pa.RecordBatch.from_pylist([row(key, rows)], schema)

    return run


# -- above the chunks --------------------------------------------------------------------------------------------


def butterfly(nodes: DataFrame, tree: str) -> DataFrame:
    """``nodes``: ``tree, place, places, digest, path``, one row for each node of each tree's lowest level (places from 0 without gaps).

    Returns them with the digest of their tree's root, and the path to it appended. Rounds: logarithm of the most places.
    """
    most = nodes.agg(F.max("places")).first()[0] or 0
    span = 1
    while span < most:
        nodes = written(_exchanged(nodes, tree, span))
        span *= FANOUT
    return nodes


def _exchanged(nodes: DataFrame, tree: str, span: int) -> DataFrame:
    """One round: each node's row holds the digest of the subtree of ``span`` places around it, and gets that of the next larger one.

    A row sends its digest to the rows at its own offset in the sibling subtrees. The last subtree of a tree may have fewer
    rows than its siblings, so its rows also serve the offsets that it lacks. No more than ``FANOUT`` digests meet anywhere.
    """
    nodes = nodes.withColumn("_index", F.expr(f"place div {span}")).withColumn("_offset", F.expr(f"place % {span}"))
    members = F.least(F.lit(span).cast("long"), F.col("places") - F.col("_index") * span)
    growing = F.col("places") > span
    at = (F.col("_index") % FANOUT).cast("int").alias("at")
    served = F.explode(F.sequence(F.col("_offset"), F.lit(span - 1).cast("long"), members)).alias("_slot")
    sent = nodes.filter(growing).select(tree, F.expr(f"_index div {FANOUT}").alias("_run"), at, "_offset", "place", "places", "digest", "path", served)
    own = F.when(F.col("_slot") == F.col("_offset"), F.struct("place", "places", "path"))
    met = sent.groupBy(tree, "_run", "_slot").agg(F.sort_array(F.collect_list(F.struct("at", "digest", own.alias("own")))).alias("met"))
    met = met.withColumn("_nodes", F.transform("met", lambda x: F.struct(x["at"].alias("at"), x["digest"].alias("digest"))))
    met = met.select(tree, "_nodes", F.explode(F.filter("met", lambda x: x["own"].isNotNull())).alias("one"))
    others = F.transform(F.filter("_nodes", lambda x: x["at"] != F.col("one.at")), lambda x: x["digest"])
    step = F.array(F.struct(F.col("one.at").alias("place"), others.alias("siblings")))
    parent = F.sha2(F.concat_ws("", F.transform("_nodes", lambda x: x["digest"])), 256)
    grown = met.select(
        tree, F.col("one.own.place").alias("place"), F.col("one.own.places").alias("places"), parent.alias("digest"),
        F.concat(F.col("one.own.path"), step).cast(PATH).alias("path"),
    )
    return grown.unionByName(nodes.filter(~growing).select(*grown.columns))


# -- the manifest ------------------------------------------------------------------------------------------------


def write_manifest(docs: DataFrame, path: str, claimed: Column | None = None, chunk_levels: int = CHUNK_LEVELS) -> None:
    """Write ``chunks`` (ids and digests of up to ``FANOUT ** chunk_levels`` leaves a row) and ``paths`` (a row for each chunk: subroot, root, the
    siblings from its digest to the root) under ``path``.

    ``claimed`` is another digest for some rows, null for the rest: what a later copy of the row hashes to. Proofs are held against it.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    leaves = FANOUT**chunk_levels
    other = F.lit(None).cast("binary") if claimed is None else claimed
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("leaf"), other.alias("claimed"))
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()))
    rows = positions(rows, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc(), F.col("_row").asc()])
    rows = rows.select("source", F.expr(f"position div {leaves}").alias("chunk"), "size", "position", "doc_id", "leaf", "claimed")
    dealt = rows.repartition("source", "chunk").sortWithinPartitions("source", "chunk", "position").drop("position")
    dealt.mapInArrow(_packed(chunk_levels), CHUNKS).write.parquet(f"{path}/chunks")
    places = F.expr(f"(size + {leaves - 1}) div {leaves}")
    nodes = spark.read.parquet(f"{path}/chunks").select(
        "source", F.col("chunk").alias("place"), places.alias("places"), "digest", F.expr(f"cast(array() as {PATH})").alias("path")
    )
    chunks = butterfly(written(nodes), "source")
    tops = chunks.filter("place = 0").select("source", "digest", F.lit(0).alias("_all"))
    tops = positions(tops, ["_all"], [F.col("source").asc_nulls_first()], "place", "places")
    tops = tops.select("_all", "source", "place", "places", F.col("digest").alias("subroot"), "digest", F.expr(f"cast(array() as {PATH})").alias("path"))
    names = written(tops.select(F.col("place").alias("_place"), F.col("source").alias("_source"), "subroot"))
    tops = butterfly(written(tops.select("_all", "place", "places", "digest", "path")), "_all")
    tops = tops.join(sized(names), F.col("place") == F.col("_place"))
    tops = written(tops.select("_source", "subroot", F.col("digest").alias("root"), F.col("path").alias("_upper")))
    joined = chunks.join(sized(tops, BROADCAST_PATHS), F.col("source").eqNullSafe(F.col("_source")))
    joined.select("source", F.col("place").alias("chunk"), "subroot", "root", F.concat("path", "_upper").alias("path")).write.parquet(f"{path}/paths")


def _proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split(" ")[0] for part in PROOFS.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            leaves = [x.hex() for x in row["leaves"]]
            levels = levels_of(leaves, row["levels"])
            upper = [(step["place"], step["siblings"]) for step in row["path"]]
            above = [x for _, others in upper for x in others]
            out = []
            for at, (doc_id, own, claim) in enumerate(zip(row["ids"], leaves, row["claimed"], strict=True)):
                lower = list(_siblings(levels, at))
                proof = _hash([*(x for _, others in lower for x in others), *above])
                root = fold(claim.hex() if claim is not None else own, [*lower, *upper])
                out.append((doc_id, own, row["subroot"], row["root"], proof, root, root == row["root"]))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


def read_proofs(spark: SparkSession, path: str) -> DataFrame:
    """Each document's leaf, subroot, root, proof, and the root to which its claimed digest (else its leaf) folds."""
    bounded_batches(spark)
    chunks, paths = spark.read.parquet(f"{path}/chunks"), spark.read.parquet(f"{path}/paths")
    paths = sized(paths.withColumnsRenamed({"source": "_source", "chunk": "_chunk"}), BROADCAST_PATHS)
    joined = chunks.join(paths, chunks["source"].eqNullSafe(paths["_source"]) & (chunks["chunk"] == paths["_chunk"]))
    return joined.select("levels", "ids", "leaves", "claimed", "subroot", "root", "path").mapInArrow(_proved, PROOFS)


def proved_documents(docs: DataFrame, claimed: Column | None = None, path: str | None = None, chunk_levels: int = CHUNK_LEVELS) -> DataFrame:
    """Write the manifest of ``docs`` (to scratch unless ``path`` is given) and read every proof back from it."""
    spark = docs.sparkSession
    path = path or scratch_path(spark)
    write_manifest(docs, path, claimed, chunk_levels)
    return read_proofs(spark, path)
