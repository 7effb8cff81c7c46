"""Near-duplicate vectors by product quantisation, with bounds that lose no link.

**Index.** Unit vectors are dealt to the nearest of ``lists`` coarse centres; the residual is coded by ``parts`` subspace codebooks of up to 256
words. Centres and codebooks are fitted in numpy on a bounded sample (about ``sample`` vectors chosen by hash); every vector is indexed. For each
vector the error of its code is kept.

**Search.** Unit vectors of cosine ``c`` are ``d = sqrt(2 - 2c)`` apart. A vector probes every list whose border is within ``d``: a partner in
another list lies beyond the plane between both centres, so these probes are sufficient. In a list, distances to codes are read from a table per
query and subspace; by the triangle inequality a partner's code is at most ``d`` plus its code's error away. What is left is compared by
cosine in double precision. Recall is therefore 1, whatever the fit.

**Skew.** Vectors with equal label and components form one class before anything else and count with their number. Lists are cut into chunks of
members and of queries by counted sizes; each pair of chunks is one small task group, which returns a count per query and the
edges of a spanning forest, never all pairs.

**Cases.** Vectors that are null, empty, zero, or hold null or non-finite components, and those without a label, link with
nothing. Vectors of different lengths are not compared. Repeated rows link with each other. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import _roots, components, sized
from tidemark.operators.scratch import written

MEMBERS, QUERIES = 4096, 8192
_SLACK = 1e-6


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0))


def _means(x: np.ndarray, k: int, rng, rounds: int = 10) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _distances(x, c).argmin(1)
        for j in range(len(c)):
            if (near == j).any():
                c[j] = x[near == j].mean(0)
    return c


class Quantiser:
    """Coarse centres and residual codebooks for vectors of one length."""

    def __init__(self, x: np.ndarray, lists: int, parts: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.centres = _means(x, lists, rng)
        rest = x - self.centres[_distances(x, self.centres).argmin(1)]
        self.cuts = np.array_split(np.arange(x.shape[1]), min(parts, x.shape[1]))
        self.books = [_means(rest[:, cut], 256, rng, 6) for cut in self.cuts]
        self.between = _distances(self.centres, self.centres)

    def encode(self, x: np.ndarray):
        """Nearest list, codes and distance of each vector to what its code stands for."""
        home = _distances(x, self.centres).argmin(1)
        rest = x - self.centres[home]
        codes = np.stack([_distances(rest[:, cut], book).argmin(1) for cut, book in zip(self.cuts, self.books, strict=True)], axis=1)
        said = np.concatenate([book[codes[:, s]] for s, book in enumerate(self.books)], axis=1)
        return home, codes.astype(np.uint8), np.linalg.norm(rest - said, axis=1)

    def probes(self, x: np.ndarray, home: np.ndarray, d: float) -> np.ndarray:
        """Lists that may hold a vector within ``d``: their border with the home list is at most ``d`` away."""
        far = _distances(x, self.centres) ** 2
        own = np.take_along_axis(far, home[:, None], 1)
        return (far - own) <= 2 * (d + _SLACK) * self.between[home]

    def tables(self, x: np.ndarray, one: int) -> np.ndarray:
        """Squared distances ``(queries, subspaces, codes)`` of the queries' residuals in a list to all code words."""
        rest = x - self.centres[one]
        out = np.full((len(x), len(self.cuts), 256), np.inf)
        for s, (cut, book) in enumerate(zip(self.cuts, self.books, strict=True)):
            out[:, s, : len(book)] = _distances(rest[:, cut], book) ** 2
        return out


def _unit(raw: list) -> np.ndarray:
    x = np.array(raw, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


_CODED = "node long, n long, label string, size int, list int, vector array<double>, codes binary, err double, probes array<int>"


def _coded(models: dict[int, Quantiser], d: float):
    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                pdf = whole.slice(at, 2048).to_pandas()
                for size, part in pdf.groupby("size"):
                    q = models[int(size)]
                    x = _unit(part["vector"].tolist())
                    home, codes, err = q.encode(x)
                    near = q.probes(x, home, d)
                    yield pa.RecordBatch.from_pandas(
                        pd.DataFrame({
                            "node": part["node"], "n": part["n"], "label": part["label"], "size": part["size"].astype("int32"), "list": home.astype("int32"),
                            "vector": part["vector"], "codes": [c.tobytes() for c in codes], "err": err,
                            "probes": [np.flatnonzero(p).astype(np.int32) for p in near],
                        }), preserve_index=False,
                    )

    return run


def _compared(models: dict[int, Quantiser], threshold: float, d: float):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        q, one = models[int(key[1])], int(key[2])
        asked, held = pdf[pdf["role"] == 1], pdf[pdf["role"] == 0]
        out = []
        if len(asked) and len(held):
            raw, mine = np.array(held["vector"].tolist(), np.float64), held["node"].to_numpy()
            norm = np.sqrt((raw * raw).sum(1))
            codes = np.frombuffer(b"".join(held["codes"]), np.uint8).reshape(len(held), -1)
            reach = d + held["err"].to_numpy() + _SLACK
            weight, a, b = held["n"].to_numpy(), [], []
            for at in range(0, len(asked), 256):
                part = asked.iloc[at : at + 256]
                y = np.array(part["vector"].tolist(), np.float64)
                length = np.sqrt((y * y).sum(1))
                table = q.tables(y / length[:, None], one)
                far = sum(table[:, s, :][:, codes[:, s]] for s in range(codes.shape[1]))
                i, j = np.nonzero(np.sqrt(far) <= reach[None])
                good = ((y[i] * raw[j]).sum(1) / (length[i] * norm[j])) >= threshold
                i, j = i[good], j[good]
                nodes = part["node"].to_numpy()
                other = nodes[i] != mine[j]
                i, j = i[other], j[other]
                links = np.bincount(i, weight[j], len(part)).astype(np.int64)
                some = links > 0
                out.append(pd.DataFrame({"node": nodes[some], "links": links[some], "a": 0, "b": 0, "edge": False}))
                a.append(nodes[i])
                b.append(mine[j])
            a, b = np.concatenate(a), np.concatenate(b)
            if len(a):
                node, root = _roots(a, b)
                out.append(pd.DataFrame({"node": 0, "links": 0, "a": node, "b": root, "edge": True})[node != root])
        empty = pd.DataFrame({"node": [], "links": [], "a": [], "b": [], "edge": []}).astype({"node": "int64", "links": "int64", "a": "int64", "b": "int64", "edge": bool})
        return pd.concat([empty, *out]).astype(empty.dtypes.to_dict())

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.98, lists: int = 32, parts: int = 8, sample: int = 8000) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    d = float(np.sqrt(2 - 2 * threshold))
    x = F.col("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    power = F.aggregate(x, F.lit(0.0), lambda s, c: s + c * c)
    usable = F.coalesce(F.col("label").isNotNull() & finite & (F.size(x) > 0) & (power > 0) & (power < float("inf")), F.lit(False))
    keys = {k: F.when(usable, F.xxhash64("label", "v", F.lit(k))) for k in ("k1", "k2")}
    rows = rows.withColumns(keys)
    classes = rows.filter("k1 IS NOT NULL").groupBy("k1", "k2").agg(
        F.any_value("label").alias("label"), F.any_value("v").alias("vector"), F.count("*").alias("n"), F.min("vec_id").alias("least")
    )
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("vector")))
    sizes = {r[0]: r[1] for r in classes.groupBy("size").count().collect()}
    chance = F.pmod(F.xxhash64("k1", "k2"), F.lit(1 << 30)) / float(1 << 30)
    models = {}
    for size, count in sizes.items():
        got = classes.filter((F.col("size") == size) & (chance < max(sample, 1) / count)).select("k1", "vector").collect()
        got = got or classes.filter(F.col("size") == size).select("k1", "vector").limit(1).collect()
        models[size] = Quantiser(_unit([r.vector for r in sorted(got)]), lists, parts)
    coded = classes.select("node", "n", "label", "size", "vector").mapInArrow(_coded(models, d), _CODED)
    coded = written(coded)
    place = ["label", "size", "list"]
    probes = coded.select("label", "size", F.explode("probes").alias("list"))
    chunks = coded.groupBy(*place).agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("m")).join(
        probes.groupBy(*place).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("q")), place
    )
    chunks = sized(written(chunks))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    held = coded.join(chunks, place).select(*place, dealt("m").alias("mc"), every("q").alias("qc"), "node", "n", "vector", "codes", "err", F.lit(0).alias("role"))
    asked = coded.select("label", "size", F.explode("probes").alias("list"), "node", "vector").join(chunks, place)
    asked = asked.select(*place, every("m").alias("mc"), dealt("q").alias("qc"), "node", F.lit(0).cast("long").alias("n"), "vector", F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("err"), F.lit(1).alias("role"))
    found = held.unionByName(asked).groupBy(*place, "mc", "qc").applyInPandas(_compared(models, threshold, d), "node long, links long, a long, b long, edge boolean")
    found = written(found)
    group = components(found.filter("edge").select("a", "b"))
    links = found.filter("NOT edge").groupBy("node").agg(F.sum("links").alias("links"))
    told = classes.join(links, "node", "left").join(group, "node", "left").withColumn("c", F.coalesce("component", "node"))
    least = told.groupBy("c").agg(F.min("least").alias("component_id"))
    told = told.join(least, "c").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "k1", "k2").join(sized(written(told)), ["k1", "k2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
