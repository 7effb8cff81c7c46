"""Mixing documents to target weights with soft membership in domains.

A classifier learned from the labels table gives each document a posterior over the domains ``good``, ``poor`` and ``toxic``. A
document of ``n`` tokens and posterior ``p`` that is used ``r`` times adds ``r n p`` to the domains' expected token totals ``A r``. Rates start at 1
and are fitted by projected gradient on the least squares of ``A r - b``, ``b`` being the targets' totals:
``r <- max(0, r - p . g)`` with ``g = H^-1 (A r - b)`` and ``H = sum of n p p'``. This is gradient descent in the metrics ``H^-1`` (domains) and ``n``
(documents), in which step 1 cannot overshoot. Each step is one aggregation over all documents; only a vector with one number per domain
reaches the driver. The total is set so that the largest target's domain keeps the tokens it has: its documents have
rates near 1.

``copies`` rounds a rate up or down by a hash of the row, so that its mean is the rate.

**Model.** Multinomial logistic regression over hashed words and a few shares of characters, trained in numpy on a bounded sample: about
``sample_docs`` labelled rows chosen by hash, the same number of each domain. Everything else covers all rows.

**Cases.** Null and empty texts have no tokens and the mean posterior; they do not weigh in the fit. Null labels count as 0. Without a labelled
row, every posterior is uniform. A domain that no document can belong to keeps its shortfall. Repeated rows are mixed alike;
columns named like a result are replaced, others pass through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import blank_if_null, bounded_batches, bounded_sample, buffers, give_back, labelled, pieces, word_hashes
from tidemark.operators.scratch import written

DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}
HASHED = 1 << 12
_SHARES = ((65, 91), (48, 58), (33, 48), (58, 65), (91, 97), (123, 127), (128, 256))  # byte ranges: capitals, digits, signs, ...
_RANGE = np.full(256, len(_SHARES), np.int64)
for _i, (_a, _b) in enumerate(_SHARES):
    _RANGE[_a:_b] = _i
_DENSE = len(_SHARES) + 2


@dataclass
class Mixture:
    words: np.ndarray  # (HASHED, domains)
    dense: np.ndarray  # (_DENSE, domains)
    shift: np.ndarray
    steps: list[list[float]] = field(default_factory=list)
    totals: dict[str, float] = field(default_factory=dict)
    targets: dict[str, float] = field(default_factory=dict)


def _features(array: pa.Array):
    """For runs of texts (each ending in a blank): hashed words, document of each, words per document, shares."""
    data, offsets = buffers(array)
    for first, last in pieces(data, offsets):
        part, at = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        words, starts = word_hashes(part)
        n = np.diff(np.searchsorted(starts, at))
        doc = np.repeat(np.arange(last - first), n)
        kind = np.bincount(np.repeat(np.arange(last - first), np.diff(at)) * (len(_SHARES) + 1) + _RANGE[part], minlength=(last - first) * (len(_SHARES) + 1))
        size = np.maximum(np.diff(at), 1)[:, None]
        shares = kind.reshape(-1, len(_SHARES) + 1)[:, : len(_SHARES)] / size
        dense = np.concatenate([np.sqrt(shares), np.log1p(n)[:, None] / 10, size / np.maximum(n, 1)[:, None] / 20], axis=1)
        yield (words % np.uint64(HASHED)).astype(np.int64), doc, n, dense.astype(np.float32)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def fit_classifier(texts: list[str], domains: list[int], rounds: int = 150) -> Mixture:
    x, row = np.zeros((len(texts), HASHED + _DENSE), np.float32), 0  # the only large array of the driver
    for at in range(0, len(texts), 256):
        for words, doc, n, dense in _features(pa.array([t + " " for t in texts[at : at + 256]], pa.string())):
            cell, times = np.unique(doc * HASHED + words, return_counts=True)
            doc, word = cell // HASHED, cell % HASHED
            x[row + doc, word] = times / np.sqrt(n)[doc]
            x[row : row + len(n), HASHED:] = dense
            row += len(n)
    y = np.eye(len(DOMAINS), dtype=np.float32)[domains]
    w, shift = np.zeros((x.shape[1], len(DOMAINS)), np.float32), np.zeros(len(DOMAINS), np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        d = (_softmax(x @ w + shift) - y) / len(y)
        g = x.T @ d + 1e-5 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        shift -= d.sum(0)
    return Mixture(w[:HASHED], w[HASHED:], shift)


def learn_domains(docs: DataFrame, labels: DataFrame, sample_docs: int = 3000, sample_chars: int = 60_000_000) -> Mixture:
    """The sample holds at most twice ``sample_docs`` rows, however often ids repeat, of at most ``sample_chars`` characters."""
    toxic, good = F.max(F.coalesce("toxic", F.lit(0))), F.max(F.coalesce("quality", F.lit(0)))
    marks = labels.groupBy("doc_id").agg(F.when(toxic == 1, 2).when(good == 1, 0).otherwise(1).alias("_domain"))
    counts = {r[0]: r[1] for r in marks.groupBy("_domain").count().collect()}
    if not counts:
        return Mixture(*(np.zeros((k, len(DOMAINS)), np.float32) for k in (HASHED, _DENSE)), np.zeros(len(DOMAINS), np.float32))
    share = sample_docs / len(counts)
    odds = F.coalesce(*(F.when(F.col("_domain") == k, share / n) for k, n in counts.items()))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30) < odds)  # a bounded sample
    got = labelled(docs.select("doc_id", blank_if_null().alias("text")), marks).select("text", "_domain")
    got = sorted(map(tuple, bounded_sample(got, 2 * sample_docs, sample_chars).collect()))
    model = fit_classifier([g[0] for g in got], [g[1] for g in got])
    # The sample holds the domains in equal parts: back to their shares among all labels.
    taken = np.bincount([g[1] for g in got], minlength=len(DOMAINS))
    for k, n in counts.items():
        model.shift[k] += np.log(n / max(1, taken[k]))
    return model


def _posterior(model: Mixture) -> Column:
    @F.arrow_udf("struct<n:long,p:array<double>>")
    def posterior(texts: pa.Array) -> pa.Array:
        sizes, probabilities = [np.zeros(0, np.int64)], [np.zeros((0, len(DOMAINS)))]
        for words, doc, n, dense in _features(texts):
            z = np.stack([np.bincount(doc, model.words[words, k], len(n)) for k in range(len(DOMAINS))], axis=1)
            z = z / np.sqrt(np.maximum(n, 1))[:, None] + dense @ model.dense + model.shift
            sizes.append(n)
            probabilities.append(_softmax(z))
        give_back()
        p = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(probabilities).reshape(-1)), len(DOMAINS)).cast(pa.list_(pa.float64()))
        return pa.StructArray.from_arrays([pa.array(np.concatenate(sizes)), p], names=["n", "p"])

    return posterior(F.concat(blank_if_null(), F.lit(" ")))


def _rate(p: Column, steps: list[list[float]]) -> Column:
    """The rate after the given steps."""
    r = F.lit(1.0)
    if steps:
        every = F.array(*(F.array(*map(F.lit, s)) for s in steps))
        dot = lambda g: sum((p[k] * g[k] for k in range(1, len(DOMAINS))), p[0] * g[0])
        r = F.aggregate(every, r, lambda acc, g: F.greatest(acc - dot(g), F.lit(0.0)))
    return r


def fit_rates(docs: DataFrame, model: Mixture, targets: dict[str, float] = TARGETS, rounds: int = 30, close: float = 1e-9) -> Mixture:
    """Steps whose rates bring expected totals to ``targets`` (shares, which need not add up to 1)."""
    bounded_batches(docs.sparkSession)
    # Filtered when read: of a filter before that, Spark would run the classifier a second time, in further workers.
    table = written(docs.select(_posterior(model).alias("x")).select("x.n", "x.p")).filter("n > 0")
    share = np.array([targets[d] for d in DOMAINS], float)
    share /= share.sum()
    p, n, k = F.col("p"), F.col("n"), range(len(DOMAINS))
    first = table.agg(*(F.sum(n * p[i] * p[j]).alias(f"h{i}{j}") for i in k for j in k), *(F.sum(n * p[i]).alias(f"t{i}") for i in k)).first()
    have = np.array([first[f"t{i}"] or 0.0 for i in k])
    inverse = np.linalg.pinv(np.array([[first[f"h{i}{j}"] or 0.0 for j in k] for i in k]))
    lead = int(share.argmax())
    want = share * (have[lead] / share[lead])
    steps: list[list[float]] = []
    for _ in range(rounds):
        gap = have - want
        if np.abs(gap).sum() <= close * max(1.0, want.sum()):
            break
        steps.append((inverse @ gap).tolist())
        r = _rate(p, steps)
        now = table.agg(*(F.sum(n * r * p[i]).alias(f"t{i}") for i in k)).first()
        have = np.array([now[f"t{i}"] or 0.0 for i in k])
    model.steps, model.totals = steps, dict(zip(DOMAINS, have.tolist(), strict=True))
    model.targets = dict(zip(DOMAINS, want.tolist(), strict=True))
    return model


def with_rates(docs: DataFrame, model: Mixture) -> DataFrame:
    """``docs`` with ``n_tokens``, one posterior ``p_<domain>`` each, ``rate`` and ``copies``."""
    out = docs.withColumn("_x", _posterior(model)).withColumn("n_tokens", F.col("_x.n"))
    for i, d in enumerate(DOMAINS):
        out = out.withColumn(f"p_{d}", F.col("_x.p")[i])
    out = out.withColumn("rate", _rate(F.array(*(F.col(f"p_{d}") for d in DOMAINS)), model.steps))
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
    return out.withColumn("copies", F.floor(F.col("rate") + chance)).drop("_x")
