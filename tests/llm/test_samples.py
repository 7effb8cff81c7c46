"""What is taken to the driver to fit a model is bounded by rows and characters, whatever ids say."""

import numpy as np
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def test_samples_are_cut_by_rows_and_characters(spark):
    from tidemark.llm.common import bounded_sample

    rows = spark.range(20_000).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(1).alias("y"))
    got = bounded_sample(rows, 300, 10**9).collect()
    assert len(got) == len(set(got)) == 300
    assert sorted(got) == sorted(bounded_sample(rows.repartition(7), 300, 10**9).collect())
    assert sum(len(r.text) for r in bounded_sample(rows, 300, 500).collect()) <= 500
    long = rows.limit(5).union(spark.createDataFrame([("x" * 10_000, 1)], rows.schema))
    assert bounded_sample(long, 300, 5_000).count() == 5
    assert bounded_sample(rows.select(F.lit("same").alias("text"), "y"), 300, 10**9).count() == 1
    assert bounded_sample(rows.limit(0), 300, 100).count() == 0


def test_one_id_on_many_rows_does_not_fill_the_driver(spark, monkeypatch):
    from tidemark.llm import mixing, toxicity

    docs = spark.range(20_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"))
    docs = docs.union(spark.createDataFrame([(i, f"other text {i} vile{i % 3}") for i in range(100, 140)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1, 0)] + [(i, 0, i % 2) for i in range(100, 140)], LABELS)
    sizes = []
    fit = mixing.fit_classifier
    monkeypatch.setattr(mixing, "fit_classifier", lambda texts, domains, **k: sizes.append(len(texts)) or fit(texts, domains, rounds=2))
    mixing.learn_domains(docs, labels, sample_docs=100)
    curve = toxicity._fit_curve
    monkeypatch.setattr(toxicity, "_fit_curve", lambda x, *a: sizes.append(len(x)) or curve(x, *a))
    toxicity.learn(docs, labels.select("doc_id", "toxic"), sample_docs=100)
    assert len(sizes) == 2 and max(sizes) <= 200


def test_many_short_texts_do_not_fill_the_driver():
    import random
    import tracemalloc

    from tidemark.llm import mixing

    rng = random.Random(3)
    words = ["w%d" % i for i in range(500)]
    texts = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(2000)] + ["", " ", "one"]
    mixing.fit_classifier(texts[:3], [0, 1, 2], rounds=1)  # tables that are made once
    tracemalloc.start()
    model = mixing.fit_classifier(texts, [i % 3 for i in range(len(texts))], rounds=2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 2 * 4 * len(texts) * mixing.HASHED
    assert model.words.shape == (mixing.HASHED, len(mixing.DOMAINS)) and np.isfinite(model.words).all() and np.abs(model.words).sum() > 0


def test_labels_are_joined_alike_with_and_without_a_broadcast(spark, monkeypatch):
    from tidemark.llm import common

    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (4, "e")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 0), (2, 1), (9, 1)], "doc_id long, y int")
    want = [(1, "a", 0), (1, "b", 0), (2, "c", 1)]
    assert sorted(map(tuple, common.labelled(docs, marks).collect())) == want
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    assert sorted(map(tuple, common.labelled(docs, marks).collect())) == want


def test_cue_words_are_found_as_by_a_pattern():
    import random

    from tidemark.llm.toxicity import _WORD, _band, _finder

    rng, cues = random.Random(1), {"clo": 1, "=vile": 2, "mordan": 3, "éte": 1}
    finder = _finder(cues)
    parts = ["clo", "CLOud", "vile", "Vilest", "xclo", "1clo", "_vil", "mor", "Mordant", "été", "Étech", "²clo", " ", ".", "\n", "K", "-"]
    for _ in range(500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        want = [m.start() for m in finder.pattern.finditer(text) if _band(cues, _WORD.match(text, m.start())[0])]
        assert list(dict.fromkeys(finder.starts(text))) == want
    assert list(finder.starts("İ clo")) == [2] and _finder({}) is None
