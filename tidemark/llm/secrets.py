"""Secret scan with multipart credential linking.

**Base spans**, leftmost and non-overlapping for each kind, over whole texts: ``assign`` (a key word, ``=`` or ``:``, a value of 6 or more
characters), ``access`` (access key identifiers of 20 or more characters), ``hex`` (24 or more hex digits).

**Linking.** Weak parts mean little alone: short assigned values (``weak_value``), user or key names (``weak_identity``), bare strings
that look random (``weak_secret``) and service addresses (``weak_endpoint``). Each part, weak or base, is an identity, a secret or an endpoint, and
reaches ``reach`` characters to both sides within its scope (a paragraph: text between blank lines). A weak part is reported only if
a part of another class lies in its reach and, with it, a secret and one of the other two classes are present. Parts meet in an interval join: they
are dealt by document, scope and cell of ``reach`` characters, a part to every cell that it covers and a weak part to every cell within its reach, and
distances are compared. The join only asks whether a part exists, so repeated parts make no pairs.

**Cases.** Null and empty texts have no spans and the hash of an empty text. Rows are told apart by a number given when they are
scanned, so repeated rows and ids keep their own results. Offsets are code points, ends exclusive. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import blank_if_null, bounded_batches
from tidemark.operators.scratch import written

#: Fixed values of the base kinds.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}", re.A)
_HEX = re.compile(r"[0-9a-f]{24,}", re.A)
#: Weak kinds.
_IDENTITY = re.compile(r"""(?:user(?:name)?|login|client_?id|access_?key(?:_?id)?|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{3,})""", re.A | re.I)
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])", re.A)
_ENDPOINT = re.compile(r"(?:[a-z][a-z0-9+.-]{1,12}://[^\s\"'<>]+)|(?:(?:host|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+\.[A-Za-z]{2,})", re.A | re.I)
_BLANK_LINES = re.compile(r"\n[ \t\r]*\n")

BASE, WEAK = ("assign", "access", "hex"), ("weak_value", "weak_identity", "weak_secret", "weak_endpoint")
IDENTITY, SECRET, ENDPOINT = 0, 1, 2
_CLASS = {"assign": SECRET, "access": IDENTITY, "hex": SECRET, "weak_value": SECRET, "weak_identity": IDENTITY, "weak_secret": SECRET, "weak_endpoint": ENDPOINT}


def _entropy(s: str) -> float:
    return -sum(c / len(s) * math.log2(c / len(s)) for c in Counter(s).values())


def spans_of(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and weak parts of one text."""
    base, weak = [], []
    for m in _ASSIGN.finditer(text):
        (base if len(m[2]) >= 6 else weak).append(("assign" if len(m[2]) >= 6 else "weak_value", *m.span()))
    base += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    base += [("hex", *m.span()) for m in _HEX.finditer(text)]
    weak += [("weak_identity", *m.span(1)) for m in _IDENTITY.finditer(text)]
    weak += [("weak_endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    for m in _RANDOM.finditer(text):
        s = m[0]
        if any(c.isdigit() for c in s) and any(c.isupper() for c in s) and any(c.islower() for c in s) and _entropy(s) >= 3.5:
            weak.append(("weak_secret", *m.span()))
    base.sort(key=lambda s: (s[1], BASE.index(s[0])))
    taken = [(a, b) for _, a, b in base]
    return base, [w for w in weak if not any(a < w[2] and w[1] < b for a, b in taken)] if weak else weak


def _text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_PART = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("scope", pa.int32()), ("class", pa.int32())])
_SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, base string, parts array<struct<kind:string,start:int,end:int,scope:int,class:int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            counts, digests, bases, parts = [], [], [], []
            for text in batch.column("text").to_pylist():
                base, weak = spans_of(text)
                counts.append(Counter(k for k, _, _ in base))
                joined = _text(base)
                digests.append(hashlib.sha256(joined.encode()).hexdigest())
                bases.append(joined)
                if weak:  # without a weak part there is nothing to link
                    breaks = [m.start() for m in _BLANK_LINES.finditer(text)]
                    parts.append([(k, a, b, sum(x < a for x in breaks), _CLASS[k]) for k, a, b in base + weak])
                else:
                    parts.append([])
            parts = pa.array([[dict(zip(("kind", "start", "end", "scope", "class"), p, strict=True)) for p in ps] for ps in parts], pa.list_(_PART))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([c[k] for c in counts], pa.int64()) for k in BASE), pa.array(digests), pa.array(bases), parts],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "parts"],
            )


def scan_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked`` of every row of ``docs`` (``doc_id``, ``text``)."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank_if_null().alias("text"))
    scanned = written(rows.mapInArrow(_scan, _SCANNED).withColumn("row", F.monotonically_increasing_id()))
    part = scanned.filter(F.size("parts") > 0).select("row", F.explode("parts").alias("p")).select("row", "p.*")
    cells = lambda a, b: F.explode(F.sequence(F.floor(a / reach), F.floor(b / reach)))
    weak = part.filter(F.col("kind").startswith("weak_")).withColumn("cell", cells(F.col("start") - reach, F.col("end") + reach))
    other = part.select("row", "scope", cells(F.col("start"), F.col("end")).alias("cell"), F.col("class").alias("c"), F.col("start").alias("s"), F.col("end").alias("e")).distinct()
    # Identities and endpoints are completed by a secret, secrets by either.
    completes = (F.col("class") == SECRET) != (F.col("c") == SECRET)
    near = (F.col("s") - F.col("end") <= reach) & (F.col("start") - F.col("e") <= reach)
    w, o = weak.alias("w"), other.alias("o")
    same = [F.col(f"w.{k}") == F.col(f"o.{k}") for k in ("row", "scope", "cell")]
    linked = w.join(o, [*same, completes & near], "left_semi").select("row", "kind", "start", "end").distinct()
    order = F.array_sort(F.collect_list(F.struct("start", "kind", "end")))
    linked = linked.groupBy("row").agg(order.alias("linked"))  # spans of one text
    text = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    out = scanned.join(linked, "row", "left")
    return out.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", _merged(text).alias("spans"), F.coalesce(F.size("linked"), F.lit(0)).cast("long").alias("n_linked"))


def _merged(text):
    """Base and linked spans by start, base kinds first at equal starts."""
    kinds = F.array(*map(F.lit, BASE + WEAK))
    base = F.transform(
        F.filter(F.split("base", ","), lambda x: x != ""),
        lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(2)).cast("int").alias("start"), F.array_position(kinds, F.split_part(x, F.lit(":"), F.lit(1))).alias("rank"), x.alias("said")),
    )
    more = F.transform("linked", lambda x: F.struct(x["start"].alias("start"), F.array_position(kinds, x["kind"]).alias("rank"), text(x).alias("said")))
    every = F.array_sort(F.concat(base, more))
    return F.when(F.col("linked").isNull(), F.col("base")).otherwise(F.array_join(F.transform(every, lambda x: x["said"]), ","))
