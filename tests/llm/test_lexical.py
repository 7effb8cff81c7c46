"""Ranked lexical search against brute force, and its index against what it is made of."""

import collections
import math
import random
import re

import numpy as np
import pytest

DOCS = "doc_id long, text string, term string, score double"
ITEMS = "item_id long, text string, shard long"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute_ranks(docs, items, k=20):
    own = [(i, collections.Counter(terms(t)), len(terms(t))) for i, t, *_ in docs]
    n_docs, all_terms = sum(n > 0 for *_, n in own), sum(n for *_, n in own)
    df = collections.Counter(t for _, c, _ in own for t in c)
    for item, text, *_ in items:
        found = []
        for doc_id, count, n in own:
            score = 0
            for t in terms(text):
                if t in count:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (1000000000 * count[t] // (1000 * count[t] + 12 * (75 + 25 * n * n_docs // all_terms)))
            if score > 0:
                found.append((score, doc_id))
        found.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        for rank, (score, doc_id) in enumerate(found[:k], 1):
            yield item, rank, doc_id, score


def corpus(rng, n=600):
    words = ["w%d" % i for i in range(300)] + ["ÉCOLE", "école", "été", "naïve", "x²", "日本", "a1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, rng.choice([" ", ", ", "\n", "-"]).join(rng.choices(words, weights, k=rng.randint(1, 60))), "clash", 0.5) for i in range(n)]
    rows += [(n, None, "t", 0.1), (n + 1, "", "t", 0.1), (n + 2, " \t.,;!", "t", 0.1), (None, "w1 w200 no id", "t", 0.1)]
    rows += [(n + 3, " ".join(rng.choices(words, weights, k=40_000)), "t", 0.1), (n + 4, "w" * 3_000_000 + " w7", "t", 0.1)]
    return rows + [(5, rows[5][1], "t", 0.1)] + [(n + 10 + i, "Same W3 text w250 w299", "t", 0.1) for i in range(150)]


def queries(rng):
    words = ["w%d" % i for i in range(300)] + ["École", "été", "日本", "unknown"]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 30))), 9) for i in range(25)]
    return items + [(30, "w250 W250 same", 9), (31, None, 9), (32, "", 9), (33, "nowhere", 9), (34, "w0", 9), (None, "w299 w3", 9), (30, "no id", 9)]


@pytest.mark.parametrize(("shard_bytes", "per_pass"), [(8 << 20, 256), (20_000, 10)])
def test_ranks_equal_brute_force(spark, tmp_path, shard_bytes, per_pass):
    from tidemark.llm import lexical

    rng = random.Random(1)
    docs, items = corpus(rng), queries(rng)
    lexical.write_index(spark.createDataFrame(docs, DOCS), str(tmp_path / "index"), shard_bytes)
    got = lexical.search(spark, str(tmp_path / "index"), spark.createDataFrame(items, ITEMS), queries=per_pass).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_ranks(docs, items))


def test_empty_tables(spark):
    from tidemark.llm.lexical import ranked_documents

    docs, items = spark.createDataFrame([(1, "a b", "", 0.0)], DOCS), spark.createDataFrame([(1, "a", 0)], ITEMS)
    assert ranked_documents(docs.limit(0), items).count() == 0
    assert ranked_documents(docs, items.limit(0)).count() == 0
    assert ranked_documents(spark.createDataFrame([(1, None, "", 0.0)], DOCS), items).count() == 0


def test_numbers_round_trip():
    from tidemark.llm.lexical import numbers, varbytes

    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**31 - 1, 5], np.int64)
    coded, at = varbytes(values)
    assert numbers(coded).tolist() == values.tolist()
    assert [len(numbers(coded[a:b])) for a, b in zip(at[:-1], at[1:])] == [1] * len(values)


def one_shard(texts):
    from tidemark.llm import lexical

    data = "".join(t + "\n" for t in texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) + 1 for t in texts)])
    head, *rows = lexical.shard_rows(0, list(range(len(texts))), np.frombuffer(data, np.uint8), offsets).to_pylist()
    shard = lexical.Shard(np.frombuffer(head["payload"], "<i4"), head["ids"], lexical.Totals(head["docs"], head["tokens"]))
    for r in rows:
        shard.lists[r["term"]] = lexical.Postings(r["df"], r["max_tf"], r["min_n"], r["blocks"], r["payload"], shard)
    return shard, rows


def test_index_holds_every_posting_and_true_bounds():
    rng = random.Random(3)
    texts = [t or "" for _, t, *_ in corpus(rng, 700)]
    shard, rows = one_shard(texts)
    counts = [collections.Counter(terms(t)) for t in texts]
    assert {r["term"]: r["df"] for r in rows} == collections.Counter(t for c in counts for t in c)
    assert any(len(shard.lists[r["term"]].last) > 2 for r in rows)
    for r in rows:
        postings = shard.lists[r["term"]]
        doc, impact = postings.decode(0, len(postings.last))
        assert doc.tolist() == [d for d, c in enumerate(counts) if r["term"] in c]
        for b in range(len(postings.last)):
            some, own = postings.decode(b, b + 1)
            assert own.max() <= postings.most[b] <= postings.bound and some[-1] <= postings.last[b]


def test_blocks_are_rejected_before_they_are_decoded():
    """A frequent word beside a rare one: documents without the rare word cannot enter, and their blocks stay packed."""
    from tidemark.llm.lexical import Best, search_shard

    rng = random.Random(4)
    texts = ["common " + " ".join("f%d" % rng.randint(0, 50) for _ in range(20)) for _ in range(20_000)]
    for d in range(100, 20_000, 900):
        texts[d] = "common rare"
    shard, _ = one_shard(texts)
    best = Best(5)
    search_shard(shard, [("common", 40), ("rare", 9000)], best)
    assert [i for _, i in best.rows] == [100, 1000, 1900, 2800, 3700]
    blocks = len(shard.lists["common"].last)
    assert blocks > 150 and shard.decoded < blocks / 2
