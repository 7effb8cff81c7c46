"""Token ids of whole texts in a bit-packed block format: writer, reader and random access.

**Format.** A folder with two Parquet tables. ``blocks`` has one row for each block of consecutive whole documents: ``shard`` and
``block`` (its place), ``bits`` (width of an id: the fewest bits that hold the
largest id of the vocabulary), ``first`` (ids before it in the shard), ``n_ids``, ``doc_ids``
and ``offsets`` (first id of each document within the block, and the end), and ``payload``: ids of ``bits`` bits each, lowest
bit first, without gaps. Id ``k`` of a block is at bit ``k * bits``, so any range unpacks alone, and whole blocks unpack in
one vectorised numpy step. ``shards`` has one row per shard: its number of ids and the ids of all shards before it. Documents are in
ascending ``doc_id`` order (null first, equal ids by a hash of the text) over shards, blocks and offsets. Spark commits both tables, so a lost executor's
tasks are repeated without leaving parts behind, and any store that Spark writes will do.

**Cases.** A null or empty text has only the end id. Repeated rows are kept, each with a start of its own. An empty table gives
empty tables. Further columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import blank_if_null, bounded_batches, give_back, sized, spread
from tidemark.operators.scratch import scratch_path

BLOCKS = "doc_ids array<long>, offsets array<int>, shard int, block int, bits int, first long, n_ids long, payload binary"
#: A block is closed when it holds so many ids.
BLOCK_IDS = 1 << 17
#: Words whose ids a task remembers at most.
WORDS_KEPT = 500_000


# -- packing -----------------------------------------------------------------------------------------------------


def id_bits(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    every = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(every[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, reading only the bytes that hold them."""
    if bits in (8, 16, 32):
        size = bits // 8
        return np.frombuffer(payload, f"<u{size}", stop - start, start * size).astype("<u4")
    first = start * bits
    raw = np.frombuffer(payload, np.uint8, (stop * bits + 7) // 8 - first // 8, first // 8)
    every = np.unpackbits(raw, bitorder="little")[first % 8 :][: (stop - start) * bits]
    wide = np.zeros((stop - start, 32), np.uint8)
    wide[:, :bits] = every.reshape(-1, bits)
    return np.packbits(wide, axis=1, bitorder="little").reshape(-1).view("<u4")


# -- encoding ----------------------------------------------------------------------------------------------------

#: How the vocabulary's byte-level pre-tokenizer splits texts of the first 256 characters (fixed values).
_LETTERS, _DIGITS, _BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
_SPLIT = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{_BLANKS}{_LETTERS}{_DIGITS}]+"
    f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
)

#: Byte-level vocabularies write each byte as one printable character: itself, or the next free one from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class _Words(dict):
    """Numbers of words; a new one is noted for encoding."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class Encoder:
    """Encodes whole texts with a vocabulary file of the tokenizers library.

    With the byte-level pre-tokenizer no merge crosses a word of the split, so each distinct word is given to the library's
    model once and texts are put together from the words' ids. Texts with characters beyond the first 256, with a special token's string, or
    of any other kind of vocabulary are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.by_words = (
            self.tokenizer.normalizer is None
            and "ByteLevel(add_prefix_space=False" in str(self.tokenizer.pre_tokenizer)
            and "use_regex=True" in str(self.tokenizer.pre_tokenizer)
            and not any(t.lstrip or t.rstrip or t.single_word for t in added)
        )
        self._forget()

    def _forget(self) -> None:
        self.words, self.flat, self.ends = _Words(), np.zeros(1 << 20, np.uint32), np.zeros(1 << 18, np.int64)

    def _learn(self) -> None:
        fresh, words = self.words.fresh, len(self.words)
        if not fresh:
            return
        tokenize = self.tokenizer.model.tokenize
        encoded = [[t.id for t in tokenize(w.encode().decode("latin-1").translate(_BYTE_SIGNS))] for w in fresh]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        known = words - len(fresh)
        base = self.ends[known]
        while len(self.ends) <= words:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ends[known + 1 : words + 1] = base + np.cumsum(lengths)
        while len(self.flat) < self.ends[words]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[base : self.ends[words]] = np.fromiter((i for ids in encoded for i in ids), np.uint32, int(lengths.sum()))
        self.words.fresh = []

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.words) > WORDS_KEPT:
            self._forget()
            give_back()
        out: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if not self.by_words or not _latin(text) or any(s in text for s in self.special):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        split = [i for i, x in enumerate(out) if x is None]
        numbers = [np.array(list(map(self.words.__getitem__, _SPLIT.findall(texts[i]))), np.int64) for i in split]
        self._learn()  # words new to any of the texts, in one call
        for i, n in zip(split, numbers, strict=True):
            begin = self.ends[n]
            lengths = self.ends[n + 1] - begin
            place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[i] = self.flat[np.repeat(begin, lengths) + place]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_many([text])[0]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=1)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


# -- writing and reading -----------------------------------------------------------------------------------------


def _blocks(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        written_ids = 0
        bits = id_bits(max(encoder.vocabulary, end_id + 1))
        docs, ids, held = [], [], 0
        end = np.array([end_id], np.uint32)

        def closed() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            payload = pack(np.concatenate(ids), bits)
            row = ([docs], [offsets.tolist()], [shard], [block], [bits], [written_ids], [int(offsets[-1])], [payload])
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, kinds, strict=True)],
                names=["doc_ids", "offsets", "shard", "block", "bits", "first", "n_ids", "payload"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc, x in zip(part.column(0).to_pylist(), encoder.encode_many(part.column(1).to_pylist()), strict=True):
                    docs.append(doc)
                    ids.append(np.concatenate([x, end]))
                    held += len(ids[-1])
                    if held >= BLOCK_IDS:
                        yield closed()
                        written_ids += held
                        docs, ids, held, block = [], [], 0, block + 1
                        if block % 8 == 0:
                            give_back()
        if docs:
            yield closed()
        docs, ids = [], []
        give_back()

    return run


def write_token_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, shards: int | None = None) -> None:
    """Encode every text of ``docs`` (``doc_id``, ``text``) and write the two tables under ``path``.

    One range exchange brings the texts in order (ids of equal ``doc_id`` may be split over shards by the text's hash);
    texts are encoded behind it, so that only texts, never ids, are shuffled.
    """
    bounded_batches(docs.sparkSession)
    spark = docs.sparkSession
    order = [F.col("doc_id").asc_nulls_first(), F.col("_tie").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), blank_if_null().alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(shards or spread(spark), *order).sortWithinPartitions(*order)
    blocks = rows.select("doc_id", "text").mapInArrow(_blocks(tokenizer, end_id), BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    # One row per shard: a running sum over the shards' totals is small however large the corpus is.
    spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids")).createOrReplaceTempView("_shard")
    spark.sql(
        "SELECT shard, n_ids, sum(n_ids) OVER (ORDER BY shard) - n_ids AS start FROM _shard"
    ).write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """All blocks, each with ``start``: ids before it in the whole corpus."""
    shards = spark.read.parquet(f"{path}/shards").select("shard", F.col("start").alias("_of"))
    blocks = spark.read.parquet(f"{path}/blocks").join(sized(shards), "shard")
    return blocks.withColumn("start", F.col("_of") + F.col("first")).drop("_of")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files alone."""

    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):  # a block at a time
                offsets = row["offsets"]
                ids = unpack(row["payload"], row["bits"], 0, offsets[-1])
                ends = zip(offsets[:-1], offsets[1:], strict=True)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in ends]
                at = np.array(offsets, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at[:-1] + row["start"]), pa.array(np.diff(at)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return read_blocks(spark, path).select("doc_ids", "offsets", "bits", "payload", "start").mapInArrow(run, schema)


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of the corpus (a bounded slice), unpacked from the blocks that hold them."""
    blocks = read_blocks(spark, path).filter((F.col("start") < stop) & (F.col("start") + F.col("n_ids") > start))
    out = [np.zeros(0, "<u4")]
    for r in blocks.select("start", "n_ids", "bits", "payload").orderBy("start").toLocalIterator():
        out.append(unpack(r.payload, r.bits, max(0, start - r.start), min(r.n_ids, stop - r.start)))
    return np.concatenate(out)


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Write ``docs`` in the format (to scratch unless ``path`` is given) and read it back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark)
    write_token_ids(docs, path, tokenizer, end_id)
    return read_documents(spark, path)
