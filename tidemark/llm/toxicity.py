"""Toxic spans and scores by a linear-chain conditional random field.

**Labelled tokens.** Labels are of whole documents. For every word and word start (3 to 8 letters) the pairs of a labelled document and a word in it are counted by label, over all
rows that may be learned from. Those found almost only in toxic documents (log odds of at least ``odds``, and more evidence than
chance gives the best of all candidates) are cues; the words that carry a cue are the tokens labelled toxic in toxic documents.

**Model.** Chains are sentences with two states, clean and toxic. Features of a token are its strongest cue's band of log odds and those of its
neighbours; most tokens have none. Weights are trained in numpy by gradient ascent on the conditional likelihood (forward-backward gives the expectations), on
sentences of a bounded sample of about ``sample_docs`` labelled documents, chosen by hash. Cues and counts cover all rows.

**Scores.** Forward-backward marginals tag tokens; runs of marginals of at least 0.5 are toxic spans. A text's score is the chance that at least one of its tokens is
toxic, ``1 - product(1 - marginal)``, put through a logistic curve fitted to the sample's labels. Every sentence of a text counts.
Sentences without a cue all have the background features, so one value, computed once, stands for them.

**Cases.** Null and empty texts score as texts without a cue. Without labels, every score is 0 and nothing is tagged. Rows repeat with
their results; further columns are ignored. Offsets are code points.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import blank_if_null, bounded_batches, bounded_sample, labelled
from tidemark.operators.scratch import written

_WORD = re.compile(r"[^\W\d_]+")
_END = re.compile(r"[.!?\n]")
BANDS, LONGEST_START = 4, 8
#: Tokens of a chain that is learned from; longer sentences give several.
PIECE = 24
#: Features of a token: its band, the left and right neighbours' bands (0: no cue).
FEATURES = 3 * (BANDS + 1)


@dataclass
class Crf:
    cues: dict[str, int]  # word start or "=word" -> band 1 to BANDS
    emit: np.ndarray  # (FEATURES, 2)
    move: np.ndarray  # (2, 2)
    curve: tuple[float, float]
    threshold: float = 0.7


def _band(cues: dict[str, int], word: str) -> int:
    word = word.lower()
    best = cues.get("=" + word, 0)
    for k in range(3, LONGEST_START + 1):
        if len(word) < k:
            break
        best = max(best, cues.get(word[:k], 0))
    return best


def _sentences(cues: dict[str, int], text: str, finder: "Finder | None"):
    """``(bands, spans)`` of the sentences that hold a cue."""
    last = -1
    for start in finder.starts(text) if finder else ():
        if start < last or not _band(cues, _WORD.match(text, start)[0]):
            continue
        begin = max(text.rfind(c, max(last, 0), start) for c in ".!?\n") + 1 or max(last, 0)
        end = _END.search(text, start)
        last = end.start() if end else len(text)
        words = list(_WORD.finditer(text, begin, last))
        yield [_band(cues, w[0]) for w in words], [w.span() for w in words]


class Finder:
    """Finds words that carry a cue: one pass over a text, whatever the number of cues."""

    def __init__(self, cues: dict[str, int]):
        #: Words that may carry one, by three letters, for texts whose lower case is longer.
        self.pattern = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(sorted({re.escape(c.lstrip('=')[:3]) for c in cues}))})", re.I)
        self.automaton = ahocorasick.Automaton()
        for cue in {c.lstrip("=") for c in cues}:
            self.automaton.add_word(cue, (len(cue) - 1, cue in cues))
        self.automaton.make_automaton()

    def starts(self, text: str) -> Iterator[int]:
        """Where such words begin, in order; a word with several cues may come several times."""
        lower = text.lower()
        if len(lower) != len(text):  # a letter became two: places would not be those of the text
            yield from (hit.start() for hit in self.pattern.finditer(text))
            return
        for end, (back, begins) in self.automaton.iter(lower):
            at = end - back
            if not (at and _WORD.match(lower, at - 1)) and (begins or not _WORD.match(lower, end + 1)):
                yield at


def _finder(cues: dict[str, int]) -> Finder | None:
    return Finder(cues) if cues else None


def _scores(emit: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """Emission scores ``(chains, length, 2)`` of padded chains."""
    padded = np.pad(bands, ((0, 0), (1, 1)))
    step = BANDS + 1
    return emit[padded[:, 1:-1]] + emit[step + padded[:, :-2]] + emit[2 * step + padded[:, 2:]]


def forward_backward(emit: np.ndarray, move: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals ``(chains, length, 2)`` and summed pair marginals ``(chains, 2, 2)``; all chains advance together."""
    k, n = emit.shape[:2]
    e, m = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(move - move.max())
    inside = np.arange(n) < sizes[:, None]
    a, b = np.zeros((k, n, 2)), np.ones((k, n, 2))
    for t in range(n):
        now = e[:, t] * (a[:, t - 1] @ m if t else 1)
        a[:, t] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, 2, 2))
    for t in range(n - 2, -1, -1):
        ahead = e[:, t + 1] * b[:, t + 1]
        back = ahead @ m.T
        both = a[:, t, :, None] * m[None] * ahead[:, None, :]
        goes = inside[:, t + 1]
        pairs[goes] += (both / both.sum(axis=(1, 2), keepdims=True))[goes]
        b[:, t] = np.where(goes[:, None], back / back.sum(axis=1, keepdims=True), 1.0)
    one = a * b
    return one / one.sum(axis=2, keepdims=True), pairs


def _padded(chains: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(c) for c in chains])
    out = np.zeros((len(chains), max(sizes)), np.int64)
    for row, c in zip(out, chains, strict=True):
        row[: len(c)] = c
    return out, sizes


def _fit_chain(chains: list[tuple[list[int], list[int], float]], rounds: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """Weights from (bands, states, how much it counts) of sentences; equal chains are counted once."""
    seen: Counter = Counter()
    for b, s, w in chains:
        seen[tuple(b), tuple(s)] += w
    bands, sizes = _padded([b for b, _ in seen])
    states, _ = _padded([s for _, s in seen])
    weight = np.array(list(seen.values()), float) / sum(seen.values())
    emit, move, step = np.zeros((FEATURES, 2)), np.zeros((2, 2)), BANDS + 1
    inside = np.arange(bands.shape[1]) < sizes[:, None]
    padded = np.pad(bands, ((0, 0), (1, 1)))
    kept = inside[:, 1:] * weight[:, None]
    counted = np.zeros((2, 2))
    np.add.at(counted, (states[:, :-1], states[:, 1:]), kept)
    for _ in range(rounds):
        one, two = forward_backward(_scores(emit, bands), move, sizes)
        gap = (np.eye(2)[states] - one) * (inside * weight[:, None])[:, :, None]
        d_emit = -0.001 * emit
        for k, at in enumerate((padded[:, 1:-1], padded[:, :-2], padded[:, 2:])):
            np.add.at(d_emit, k * step + at, gap)
        move += 0.6 * (counted - (two * weight[:, None, None]).sum(axis=0) - 0.001 * move)
        emit += 0.6 * d_emit
    return emit, move


def tag(crf: Crf, text: str, finder: Finder | None) -> tuple[float, list[tuple[int, int, float]]]:
    """Chance of no toxic token (as a log) and toxic spans ``(start, end, marginal)``."""
    clean, spans = 0.0, []
    found = list(_sentences(crf.cues, text, finder))
    if not found:
        return clean, spans
    chains, sizes = _padded([b for b, _ in found])
    marginals, _ = forward_backward(_scores(crf.emit, chains), crf.move, sizes)
    for (bands, places), one in zip(found, marginals, strict=True):
        toxic = np.clip(one[: len(bands), 1], 0, 1 - 1e-9)
        clean += float(np.log1p(-toxic[np.array(bands) > 0]).sum())
        for (a, b), p in zip(places, toxic, strict=True):
            if p >= 0.5:
                if spans and text[spans[-1][1] : a].isspace():
                    spans[-1] = (spans[-1][0], b, max(spans[-1][2], float(p)))
                else:
                    spans.append((a, b, float(p)))
    return clean, spans


def learn(docs: DataFrame, marks: DataFrame, odds: float = 2.5, support: int = 4, sample_docs: int = 1600, sample_chars: int = 40_000_000) -> Crf | None:
    """``marks``: ``doc_id`` and ``toxic`` of the rows that may be learned from.

    The sample holds at most twice ``sample_docs`` rows, however often ids repeat, of at most ``sample_chars`` characters.
    """
    marks = marks.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    have = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    if not have.get(1) or not have.get(0):
        return None
    rows = labelled(docs.select("doc_id", blank_if_null().alias("text")), marks)
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != ""))
    ones, zeros = F.sum((F.col("toxic") == 1).cast("int")), F.sum((F.col("toxic") != 1).cast("int"))
    word = rows.select("toxic", F.explode(words).alias("w")).groupBy("w").agg(ones.alias("t"), zeros.alias("f"))
    starts = [F.when(F.length("w") >= k, F.substring("w", 1, k)) for k in range(3, LONGEST_START + 1)]
    cue = written(word).select(F.explode(F.array_compact(F.array(F.concat(F.lit("="), F.col("w")), *starts))).alias("cue"), "t", "f")
    cue = written(cue.groupBy("cue").agg(F.sum("t").alias("t"), F.sum("f").alias("f")).filter(F.col("t") >= support))
    # Evidence against the labels' own share, in nats, beyond what the best of so many candidates shows by chance.
    base = have[1] / (have[1] + sum(n for k, n in have.items() if k != 1))
    share = F.col("t") / (F.col("t") + F.col("f"))
    bits = F.col("t") * F.log(share / base) + F.when(F.col("f") > 0, F.col("f") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    cue = cue.filter(bits >= float(np.log(max(1, cue.count())) + 3))
    ratio = F.log((F.col("t") + 0.5) / (have[1] + 1)) - F.log((F.col("f") + 0.5) / (have[0] + 1))
    # A word start is a cue of its own; longer cues below it add nothing, and shorter ones with the same evidence are left out.
    cue = cue.withColumn("odds", ratio).filter(F.col("odds") >= odds)
    shorter = cue.filter(~F.col("cue").startswith("=")).select(F.col("cue").alias("up"), F.col("t").alias("t_up"), F.col("f").alias("f_up"))
    bare = F.regexp_replace("cue", "^=", "")
    ups = cue.withColumn("up", F.explode(F.array(*(F.substring(bare, 1, k) for k in range(3, LONGEST_START + 1))))).filter(F.col("up") != F.col("cue"))
    spared = ups.join(shorter, "up").filter("f_up <= f + 1").select("cue").distinct()
    got = cue.join(spared, "cue", "left_anti").select("cue", "odds").collect()  # a lexicon: cues under word starts are left out
    cues = {r.cue: min(BANDS, 1 + int((r.odds - odds) / 1.0)) for r in got}
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    taken = {k: min(1.0, sample_docs / 2 / have[k]) for k in (0, 1)}
    sample = rows.filter(chance < F.when(F.col("toxic") == 1, taken[1]).otherwise(taken[0]))
    sample = bounded_sample(sample.select("text", (F.col("toxic") == 1).cast("int").alias("y")), 2 * sample_docs, sample_chars)
    sample = sorted(map(tuple, sample.collect()))
    weigh = {k: 1 / taken[k] for k in (0, 1)}  # the sample holds both labels in equal parts
    finder, chains = _finder(cues), []
    for text, toxic in sample:
        own = [(b, [int(x > 0 and toxic == 1) for x in b]) for b, _ in _sentences(cues, text, finder)]
        cut = [(b[i : i + PIECE], y[i : i + PIECE]) for b, y in own for i in range(0, len(b), PIECE)] or [([0] * 10, [0] * 10)]
        chains += [(b, y, weigh[toxic]) for b, y in cut]
    emit, move = _fit_chain(chains) if chains else (np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    crf = Crf(cues, emit, move, (1.0, 0.0))
    x = np.array([_strength(tag(crf, t, finder)[0]) for t, _ in sample])
    crf.curve = _fit_curve(x, np.array([float(y) for _, y in sample]), np.array([weigh[y] for _, y in sample]))
    return crf


def _strength(clean: float) -> float:
    return float(min(-clean, 6.0))  # -log of the chance that nothing is toxic


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    a, b = 1.0, 0.0
    weight = weight / weight.mean()
    for _ in range(2000):
        p = 1 / (1 + np.exp(-(a * x + b)))
        a += 0.1 * (((y - p) * x * weight).mean() - 1e-4 * a)
        b += 0.1 * (((y - p) * weight).mean() - 1e-4 * b)
    return float(a), float(b)


def score(docs: DataFrame, crf: Crf | None) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``toxic_spans`` (start, end, marginal)."""
    kind = "array<struct<start:int,end:int,marginal:double>>"
    if crf is None:
        return docs.withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "toxic_spans": F.array().cast(kind)})

    @F.arrow_udf(f"struct<score:double,spans:{kind}>")
    def tagged(texts: pa.Array) -> pa.Array:
        finder = _finder(crf.cues)
        scores, spans = [], []
        for text in texts.to_pylist():
            clean, found = tag(crf, text, finder)
            scores.append(1 / (1 + np.exp(-(crf.curve[0] * _strength(clean) + crf.curve[1]))))
            spans.append([{"start": a, "end": b, "marginal": p} for a, b, p in found])
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])
        return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(spans, pa.list_(span))], names=["score", "spans"])

    bounded_batches(docs.sparkSession)
    out = docs.withColumn("_tagged", tagged(blank_if_null()))
    out = out.withColumn("score", F.col("_tagged.score")).withColumn("toxic_spans", F.col("_tagged.spans"))
    return out.withColumn("predicted", (F.col("score") >= crf.threshold).cast("int")).drop("_tagged")
