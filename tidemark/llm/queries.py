"""The operators' queries over whole tables, and the SQL that they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.token_ids import encoded_documents

    return encoded_documents(_table(spark, sf_dir, "documents"), vocabulary_file(), end_id=2)


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import language

    docs = _table(spark, sf_dir, "documents")
    fold4 = fold(F.col("doc_id"), 4)
    net = language.train(docs, learn=fold4 != 2)
    held_out = F.coalesce(fold4 == 2, F.lit(False)).alias("held_out")
    return language.predict(docs.select("doc_id", "text"), net).select("doc_id", held_out, "lang_pred", "score")


@query()
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.jaccard import similar_documents

    return similar_documents(_table(spark, sf_dir, "documents"))


@query()
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.decontaminate import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import mixing

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = mixing.fit_rates(docs, mixing.learn_domains(docs, _table(spark, sf_dir, "labels")))
    return mixing.with_rates(docs, model).drop("text")


@query()
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.secrets import scan_secrets

    return scan_secrets(_table(spark, sf_dir, "documents"))


@query()
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm import toxicity

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    fold3 = fold(F.col("doc_id"), 3)
    marks = _table(spark, sf_dir, "labels").filter(fold3 != 1).select("doc_id", "toxic")
    held_out = F.coalesce(fold3 == 1, F.lit(False)).alias("held_out")
    return toxicity.score(docs, toxicity.learn(docs, marks)).select("doc_id", held_out, "score", "predicted", "toxic_spans")


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(e, lambda x: x * x)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), own AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.vec_id) AS n_links, own.component_id, v.vec_id = own.component_id AS kept
FROM v JOIN own ON own.a = v.vec_id
""")
def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.vectors import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


@query("""
WITH l AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(lines) - 1)) AS i, lines FROM l WHERE len(lines) >= 3),
win AS (SELECT doc_id, i, array_to_string(lines[i:i + 2], chr(10)) AS k FROM w
        WHERE trim(lines[i]) <> '' OR trim(lines[i + 1]) <> '' OR trim(lines[i + 2]) <> ''),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + d AS i FROM later, (VALUES (0), (1), (2)) x(d)),
g AS (SELECT doc_id, list(i) AS at FROM gone GROUP BY doc_id)
SELECT l.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(coalesce(len(g.at), 0) AS BIGINT) AS n_removed,
  md5(CASE WHEN g.at IS NULL THEN text ELSE array_to_string(
    list_filter(list_transform(lines, lambda x, i: CASE WHEN list_contains(g.at, i) THEN NULL ELSE x END), lambda x: x IS NOT NULL), chr(10)) END) AS kept_md5
FROM l LEFT JOIN g ON g.doc_id = l.doc_id
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lines import dedup_lines

    return dedup_lines(_table(spark, sf_dir, "documents")).withColumn("kept_md5", F.md5("text")).drop("text")


@query("""
SELECT conv_id, turn, 0 AS part, turn AS place, 0 AS depth, 'message' AS kind, CAST(NULL AS VARCHAR) AS call_id, 'ok' AS status,
  CASE WHEN text IS NULL THEN '{' ELSE '{"content":' || to_json(text) || CASE WHEN role IS NULL THEN '' ELSE ',' END END
    || CASE WHEN role IS NULL THEN '' ELSE '"role":' || to_json(role) END || '}' AS message
FROM conversations
""")
def op7_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold no tool calls, so that the SQL needs only the case of plain messages; tests have the others."""
    from tidemark.llm.tool_calls import linked_messages

    return linked_messages(_table(spark, sf_dir, "conversations"))


@query(r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), q AS (
  SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), s AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS tokens FROM d WHERE len(terms) > 0
), m AS (SELECT doc_id, 75 + (25 * len(terms) * s.docs) // s.tokens AS m FROM d, s
), tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * s.docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term, s.docs
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
""")
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lexical import ranked_documents

    return ranked_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.shards import sharded_rows

    rows = sharded_rows(_table(spark, sf_dir, "documents"), shards=8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query(r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, x: list_reduce(list_prepend(xor(a, x), [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda b, y: CASE WHEN b % 2 = 1 THEN xor(b // 2, 3988292384) ELSE b // 2 END)), 4294967295) % 2 = 0 AS even
  FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(CASE WHEN even THEN replace(text, chr(10), '') ELSE text END) || ':'
      || CASE WHEN even THEN replace(text, chr(10), '') ELSE text END, '-')) AS claimed
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM leaves
), low(source, level, i, digest, n) AS (
  SELECT source, 0, i, leaf, n FROM placed
  UNION ALL
  SELECT source, level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY source, level, i // 3
), tops AS (
  SELECT source, level AS levels, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1
), high(level, i, digest, n) AS (
  SELECT 0, i, subroot, n FROM tops
  UNION ALL
  SELECT level + 1, i // 3, sha256(string_agg(digest, '' ORDER BY i)), (any_value(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY level, i // 3
), root AS (SELECT digest AS root FROM high WHERE n = 1), 
nodes AS (
  SELECT source, level, i, digest FROM low WHERE n > 1 UNION ALL
  SELECT t.source, t.levels + h.level, h.i, h.digest FROM tops t, high h WHERE h.n > 1
), run AS (
  SELECT p.doc_id, p.leaf, p.claimed, p.source, t.subroot, t.levels, t.i AS top, p.i AS first FROM placed p JOIN tops t ON t.source IS NOT DISTINCT FROM p.source
), steps(doc_id, leaf, source, subroot, levels, top, level, i, folded, proof) AS (
  SELECT doc_id, leaf, source, subroot, levels, top, 0, CASE WHEN levels = 0 THEN top ELSE first END, claimed, '' FROM run
  UNION ALL
  SELECT s.doc_id, s.leaf, s.source, s.subroot, s.levels, s.top, s.level + 1, CASE WHEN s.level + 1 = s.levels THEN s.top ELSE s.i // 3 END,
    sha256(string_agg(CASE WHEN n.i = s.i THEN s.folded ELSE n.digest END, '' ORDER BY n.i)),
    s.proof || coalesce(string_agg(n.digest, '' ORDER BY n.i) FILTER (n.i <> s.i), '')
  FROM steps s JOIN nodes n ON n.source IS NOT DISTINCT FROM s.source AND n.level = s.level AND n.i // 3 = s.i // 3
  WHERE s.level < s.levels OR s.level - s.levels < (SELECT max(level) FROM high)
  GROUP BY s.doc_id, s.leaf, s.source, s.subroot, s.levels, s.top, s.level, s.i, s.folded, s.proof
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM steps, root WHERE level = levels + (SELECT max(level) FROM high)
""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document with an even crc32 of its id the copy held against the proof has lost its line breaks."""
    from tidemark.llm import merkle

    text = F.col("text")
    tampered = (fold(F.col("doc_id"), 2) == 0) & F.contains(text, F.lit("\n"))
    claimed = F.when(tampered, merkle.leaf(text=F.translate(text, "\n", "")))
    return merkle.proved_documents(_table(spark, sf_dir, "documents"), claimed)
