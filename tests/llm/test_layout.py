"""Sharding and the manifest against brute force on small fixtures."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, source string, lang string, n_chars long, text string, shard string, size long"


def fixture(rng, n=400):
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "zz", None, "one%d" % i])
        text = rng.choice(["", "x", "line\nline", None, "ä" * rng.randint(1, 300), "word " * rng.randint(1, 900)])
        rows.append((i, source, rng.choice(["en", "fr", None]), rng.choice([None, len(text or "")]), text, "clash", 5))
    rows += [(7, "hot", "en", 1, "again", "clash", 5)] * 3 + [(None, "hot", "en", 1, "no id", "clash", 5), (None, None, None, None, None, None, None)]
    rows.append((n, "a", "en", 60000, "long\n" * 60000, "clash", 5))
    return rows


# -- k-d tree ----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [3, 8])
def test_shards_are_near_equal_and_slots_gapless(spark, shards):
    from tidemark.llm.shards import sharded_rows

    rows = [r for r in fixture(random.Random(1)) if r[3] != 60000]
    got = sharded_rows(spark.createDataFrame(rows, DOCS), shards=shards).collect()
    want = sorted((r[0] is not None, r[0] or 0, len((r[4] or "").encode()) + 1, zlib.crc32((r[4] or "").encode())) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == want
    sizes, largest = {}, max(r.size for r in got)
    for s in range(shards):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert [r.doc_id for r in own] == sorted((r.doc_id for r in own), key=lambda x: (x is not None, x))
        sizes[s] = sum(r.size for r in own)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest + 0.01 * sum(sizes.values())


def test_splits_are_weighted_medians_of_the_widest_dimension(spark):
    """Against the tree built in memory: for distinct coordinates no tie-breaking is needed."""
    from tidemark.llm import shards

    rng = random.Random(2)
    wide, narrow = rng.sample(range(100_000), 300), rng.sample(range(5_000), 299) + [90_000]  # an outlier makes a node wide there
    rows = [(i, w, float(n), "t" * rng.randint(1, 40)) for i, (w, n) in enumerate(zip(wide, narrow, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, wide long, narrow double, text string")
    got = {r.doc_id: r.shard for r in shards.sharded_rows(docs, shards=5, dimensions=("wide", "narrow")).collect()}
    spans = [max(r[k] for r in rows) - min(r[k] for r in rows) for k in (1, 2)]
    axes = set()

    def split(own, leaves, first):
        if leaves == 1:
            return {r[0]: first for r in own}
        widths = [(max(r[k] for r in own) - min(r[k] for r in own)) / spans[k - 1] for k in (1, 2)]
        axis = 1 if widths[0] >= widths[1] else 2
        axes.add(axis)
        own = sorted(own, key=lambda r: r[axis])
        want, total = sum(len(r[3]) + 1 for r in own) * (leaves // 2) // leaves, 0
        cuts = []
        for k, r in enumerate(own):
            total += len(r[3]) + 1
            cuts.append((abs(total - want), -k))
        at = 1 - min(cuts)[1]
        return split(own[:at], leaves // 2, first) | split(own[at:], leaves - leaves // 2, first + leaves // 2)

    assert got == split(rows, 5, 0) and axes == {1, 2}


def test_copies_that_fill_a_third_do_not_unbalance(spark):
    from tidemark.llm.shards import sharded_rows

    rows = [(i, "s", "en", 4, "same" if i % 3 else "t%d" % i, "", 0) for i in range(300)] + [(5, "s", "en", 4, "same", "", 0)] * 150
    got = sharded_rows(spark.createDataFrame(rows, DOCS), shards=8).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    sizes = [r.b for r in got]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 30


def test_target_bytes_and_written_shards(spark, tmp_path):
    from tidemark.llm.shards import write_shards

    rows = fixture(random.Random(3))
    docs = spark.createDataFrame(rows, DOCS)
    out = write_shards(docs, str(tmp_path / "shards"), target_bytes=100_000).cache()
    total = sum(len((r[4] or "").encode()) + 1 for r in rows)
    assert out.select("shard").distinct().count() <= -(-total // 100_000) and out.count() == len(rows)
    assert sorted(map(repr, out.select(*docs.drop("shard").columns).collect())) == sorted(map(repr, docs.drop("shard").collect()))
    slots = {}
    for r in out.select("shard", "slot").collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_layout_of_empty_tables(spark, tmp_path):
    from tidemark.llm.merkle import proved_documents
    from tidemark.llm.shards import sharded_rows, write_shards

    docs = spark.createDataFrame([], DOCS)
    assert sharded_rows(docs, shards=8).count() == 0 and proved_documents(docs).count() == 0
    assert write_shards(docs.limit(0).union(spark.createDataFrame([(1, None, None, None, None, None, None)], DOCS)), str(tmp_path / "s"), shards=8).count() == 1


# -- Merkle manifest ---------------------------------------------------------------------------------------------


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_proofs(rows, change):
    """Every document's leaf, subroot, root, proof and folded root, from whole trees in memory."""

    def leaf(row):
        return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def tree(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
        return levels

    def path(levels, at):
        for nodes in levels[:-1]:
            yield at % 3, [x for k, x in enumerate(nodes) if k // 3 == at // 3 and k != at]
            at //= 3

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row[:5])
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]])
    top = tree([trees[name][-1][0] for name in names])
    for g, name in enumerate(names):
        for at, row in enumerate(groups[name]):
            steps = [*path(trees[name], at), *path(top, g)]
            folded = leaf(change(row))
            for place, others in steps:
                folded = digest("".join([*others[:place], folded, *others[place:]]))
            proof = digest("".join(x for _, others in steps for x in others))
            yield row[0], leaf(row), trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]


@pytest.mark.parametrize("chunk_levels", [1, 6])
def test_proofs_equal_whole_trees(spark, chunk_levels):
    from tidemark.llm import merkle

    rows = fixture(random.Random(4), 120)

    def change(row):
        odd = row[0] is None or zlib.crc32(str(row[0]).encode()) % 2
        return row if odd or row[4] is None else (*row[:4], row[4].replace("\n", ""))

    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    claimed = F.when(tampered, merkle.leaf(text=F.translate("text", "\n", "")))
    got = merkle.proved_documents(spark.createDataFrame(rows, DOCS), claimed, chunk_levels=chunk_levels).collect()
    want = list(brute_proofs(rows, change))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert {r.verified for r in got} == {True, False}


def test_a_lone_row_is_its_own_root(spark):
    from tidemark.llm.merkle import proved_documents

    (got,) = proved_documents(spark.createDataFrame([(1, "s", "en", 1, "t", "", 0)], DOCS)).collect()
    assert got.leaf == got.subroot == got.root == got.folded_root and got.verified and got.proof_sha256 == digest("")


def test_a_round_sends_no_more_than_two_rows_for_each_node(spark):
    """Ragged trees: every node gets exactly its siblings' digests, whatever the number of places."""
    from tidemark.llm import merkle

    trees = {t: n for t, n in enumerate([1, 2, 3, 4, 7, 10, 26, 28])}
    rows = [(t, p, n, digest(f"{t}-{p}"), []) for t, n in trees.items() for p in range(n)]
    nodes = spark.createDataFrame(rows, f"tree int, place long, places long, digest string, path {merkle.PATH}")
    got = merkle.butterfly(nodes, "tree").collect()
    assert len(got) == len(rows)
    for r in got:
        root = merkle.fold(digest(f"{r.tree}-{r.place}"), [(s.place, s.siblings) for s in r.path])
        assert root == r.digest and len({x.digest for x in got if x.tree == r.tree}) == 1
