"""Language identification by a byte convolutional network, trained here and applied to every window of a text.

A window of ``window`` bytes is embedded byte by byte, filters of several widths run over it, each filter keeps its largest
response, and a softmax layer turns these into language probabilities. A text's probabilities are the mean over all its windows, weighted
by their bytes; only text is read. The network is trained in numpy on the driver, on windows of a bounded sample: about ``sample_docs``
labelled documents in all, the same number for each language, chosen by a hash of the row, with ``windows_per_doc`` windows of each.
Everything else, including the counts per language, covers all rows.

With ``strange``, the network also learns a class of text in no known language, made from the sample (``strangers``): the sample's words
with their letters exchanged, words of random letters of this and of other scripts, and noise. ``known`` is the probability of all labelled languages together, whose
meaning does not depend on their number; without that class it is 1.

**Cases.** ``lang_pred`` is ``und`` with score 0 for a null text and for one without a letter, and for every text if no labelled row may be
learned from. Short texts are padded. Rows with a null label are not learned from. Repeated rows are predicted
alike. Further columns pass through; columns named like a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import bounded_batches, buffers, give_back

UNKNOWN = "und"
WIDTHS, FILTERS, EMBEDDED, WINDOW = (2, 3, 4, 5), 12, 8, 256
_PAD, _WIDEST = 256, max(WIDTHS)


@dataclass
class ByteNetwork:
    labels: list[str]
    embed: np.ndarray  # (257, EMBEDDED); the last row is padding
    filters: np.ndarray  # (_WIDEST * EMBEDDED, FILTERS * len(WIDTHS)); rows beyond a filter's width are 0
    bias: np.ndarray
    out: np.ndarray
    shift: np.ndarray

    def responses(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All filters at all places of windows of byte codes ``(n, WINDOW + _WIDEST - 1)``."""
        x = self.embed[codes].reshape(len(codes), -1)
        columns = sliding_window_view(x, _WIDEST * EMBEDDED, axis=1)[:, ::EMBEDDED]
        columns = np.ascontiguousarray(columns).reshape(-1, _WIDEST * EMBEDDED)
        return columns, (columns @ self.filters).reshape(len(codes), WINDOW, -1)

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        _, z = self.responses(codes)
        return _softmax(np.maximum(z.max(axis=1) + self.bias, 0) @ self.out + self.shift)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def _codes(texts: list[bytes]) -> np.ndarray:
    out = np.full((len(texts), WINDOW + _WIDEST - 1), _PAD, np.int16)
    for i, t in enumerate(texts):
        t = t[:WINDOW]
        out[i, : len(t)] = np.frombuffer(t, np.uint8)
    return out


def fit(texts: list[str], labels: list[str], epochs: int = 8, batch: int = 64, rate: float = 4e-3, seed: int = 7) -> ByteNetwork:
    """Adam on cross-entropy. Half of the windows are cut to a random length, so that short texts are learned too."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    y = np.array([names.index(x) for x in labels])
    raw = [t.encode() for t in texts]
    n_filters = FILTERS * len(WIDTHS)
    mask = np.zeros((_WIDEST, EMBEDDED, n_filters), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[:w, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(-1, n_filters)
    f32 = lambda *s, scale: rng.normal(0, scale, s).astype(np.float32)
    net = ByteNetwork(
        names, f32(257, EMBEDDED, scale=0.3), f32(_WIDEST * EMBEDDED, n_filters, scale=0.2) * mask,
        np.zeros(n_filters, np.float32), f32(n_filters, len(names), scale=0.1), np.zeros(len(names), np.float32),
    )
    params = [net.embed, net.filters, net.bias, net.out, net.shift]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            codes = _codes([raw[r][: rng.integers(8, 64)] if rng.random() < 0.5 else raw[r] for r in rows])
            n = len(rows)
            columns, z = net.responses(codes)
            best = z.argmax(axis=1)  # (n, filters)
            h = np.take_along_axis(z, best[:, None], axis=1)[:, 0] + net.bias
            active = np.maximum(h, 0)
            d = _softmax(active @ net.out + net.shift)
            d[np.arange(n), y[rows]] -= 1
            d /= n
            dh = (d @ net.out.T) * (h > 0)
            picked = columns.reshape(n, WINDOW, -1)[np.arange(n)[:, None], best]  # (n, filters, width * embedded)
            d_filters = np.einsum("nf,nfk->kf", dh, picked) * mask
            d_columns = (dh[:, :, None] * net.filters.T[None]).reshape(n, n_filters, _WIDEST, EMBEDDED)
            d_embed = np.zeros_like(net.embed)
            at_bytes = codes[np.arange(n)[:, None, None], best[:, :, None] + np.arange(_WIDEST)]
            np.add.at(d_embed, at_bytes.reshape(-1), d_columns.reshape(-1, EMBEDDED))
            d_embed[_PAD] = 0
            grads = [d_embed, d_filters, dh.sum(0), active.T @ d + 1e-4 * net.out, d.sum(0)]
            step += 1
            for i, (p, g) in enumerate(zip(params, grads, strict=True)):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                p -= rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return net


#: First and last letters of scripts that ``strangers`` writes in (fixed values).
_SCRIPTS = ((0x61, 0x7A), (0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA), (0x627, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x3041, 0x3096), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
_NOISE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-#*.,;:|~<>{}"


def strangers(texts: list[str], n: int, seed: int = 11) -> list[str]:
    """``n`` texts in no known language, shaped like ``texts``."""
    rng, out = np.random.default_rng(seed), []
    letters = sorted({c for t in texts for c in t.lower() if c.isalpha()})
    for i in range(n):
        text = texts[rng.integers(len(texts))]
        if i % 2 == 0:  # letters exchanged, the same throughout a text
            other = [letters[j] for j in rng.permutation(len(letters))]
            change = dict(zip(letters, other, strict=True)) | {x.upper(): y.upper() for x, y in zip(letters, other, strict=True)}
            out.append("".join(change.get(x, x) for x in text))
        elif i % 4 == 1:  # random letters of one script
            low, high = _SCRIPTS[rng.integers(len(_SCRIPTS))]
            out.append("".join(chr(rng.integers(low, high + 1)) if x.isalpha() else x for x in text))
        else:  # noise
            gap = rng.random() * 0.2
            out.append("".join(" " if rng.random() < gap else _NOISE[rng.integers(len(_NOISE))] for _ in text))
    return out


def train(
    docs: DataFrame, label: str = "lang", learn: Column | None = None, sample_docs: int = 1600, windows_per_doc: int = 4, strange: bool = False
) -> ByteNetwork | None:
    """Network from the rows of ``docs`` for which ``learn`` holds; None if there are none."""
    rows = docs.filter(F.col(label).isNotNull() & F.col("text").isNotNull() & (F.lit(True) if learn is None else learn))
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return None
    share = sample_docs / len(counts)
    odds = F.coalesce(*(F.when(F.col(label) == k, share / n) for k, n in counts.items()))
    chance = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    spare = F.greatest(F.length("text") - WINDOW, F.lit(0))
    pick = lambda j: F.col("text").substr((spare * j / max(1, windows_per_doc - 1)).cast("int") + 1, F.lit(WINDOW))
    cuts = F.array_distinct(F.array(*(pick(j) for j in range(windows_per_doc))))
    sample = rows.filter(chance < odds).select(F.explode(cuts).alias("text"), F.col(label).alias("label"))
    got = sorted(map(tuple, sample.collect()))
    texts, labels = [r[0] for r in got], [r[1] for r in got]
    if strange and got:
        made = strangers(texts, max(1, len(texts) // 2))
        texts, labels = texts + made, labels + [UNKNOWN] * len(made)
    return fit(texts, labels) if got else None


def _windows(data: np.ndarray, offsets: np.ndarray):
    """Start, bytes and document of every window: a text's last window ends where the text ends."""
    sizes = np.diff(offsets)
    per_doc = np.maximum(1, -(-sizes // WINDOW))
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    inside = np.minimum(place * WINDOW, np.maximum(sizes[doc] - WINDOW, 0))
    return offsets[doc] + inside, np.minimum(WINDOW, sizes[doc] - inside), doc


def _scored(net: ByteNetwork, array: pa.Array) -> np.ndarray:
    data, offsets = buffers(array)
    start, size, doc = _windows(data, offsets)
    total = np.zeros((len(offsets) - 1, len(net.labels)))
    padded = np.concatenate([data, np.zeros(WINDOW + _WIDEST, np.uint8)])
    span = np.arange(WINDOW + _WIDEST - 1)
    for at in range(0, len(start), 64):
        s, n = start[at : at + 64], size[at : at + 64]
        codes = padded[s[:, None] + span].astype(np.int16)
        codes[span[None] >= n[:, None]] = _PAD
        np.add.at(total, doc[at : at + 64], net.probabilities(codes) * n[:, None])
    return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, net: ByteNetwork | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (both of the likeliest labelled language) and ``known``."""
    if net is None:
        return docs.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0)).withColumn("known", F.lit(0.0))

    @F.arrow_udf("struct<lang:string,score:double,known:double>")
    def languages(texts: pa.Array) -> pa.Array:
        p = _scored(net, texts)
        give_back()
        p[:, [x == UNKNOWN for x in net.labels]] = 0
        known = p.sum(axis=1)
        best = p.argmax(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array([net.labels[i] for i in best], pa.string()), pa.array(np.clip(p[np.arange(len(p)), best], 0, 1)), pa.array(np.clip(known, 0, 1))],
            names=["lang", "score", "known"],
        )

    bounded_batches(docs.sparkSession)
    known = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    out = docs.withColumn("_language", languages(F.coalesce(F.col(text), F.lit(""))))
    return (
        out.withColumn("lang_pred", F.when(known, F.col("_language.lang")).otherwise(UNKNOWN))
        .withColumn("score", F.when(known, F.col("_language.score")).otherwise(0.0))
        .withColumn("known", F.when(known, F.col("_language.known")).otherwise(0.0))
        .drop("_language")
    )
