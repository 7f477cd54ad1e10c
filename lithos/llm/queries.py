"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.llm import bit_sliced, centroids, chat_format, decontaminate, language_id, licenses, near_dup, packing, secrets, spelling, substring_dedup, toxicity, warc
from lithos.session import staged, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share."""
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt where crc32(doc_id) mod 5 is not 0; a row without an id is neither learnt from nor held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = lambda c: F.crc32(F.col(c).cast("string")) % 5 == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    found = toxicity.scored(docs, model)
    return found.select(F.col("id").alias("doc_id"), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt where crc32(doc_id) mod 4 is not 2; a row without an id is neither learnt from nor held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives."""
    archives = staged(warc.write_archives(table(spark, sf_dir, "pages")), "archives")
    found = warc.read_archives(archives, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector with all others."""
    return bit_sliced.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and tags of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda x: x["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("base"), k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)],
        F.sha2(secrets.named(F.col("base")), 256).alias("base_sha256"),
        secrets.named(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts are control strings, as read back from the formatted text."""
    said = F.lit("</s>[INST] ok [/INST]").alias("text")
    roles = F.element_at(F.array(F.lit("user"), F.lit("assistant")), (F.col("id") + 1).cast("int")).alias("role")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), roles, said)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digests(chat_format.formatted(rows)).drop("attached_tokens")


def op12_drake_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds from eight hashed starts."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The form and root of every word of seven letters or more that occurs twice."""
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_near_dup": op5_near_dup,
    "op6_packing": op6_packing,
    "op7_bit_sliced": op7_bit_sliced,
    "op8_licenses": op8_licenses,
    "op9_decontaminate": op9_decontaminate,
    "op10_secrets": op10_secrets,
    "op11_chat_format": op11_chat_format,
    "op12_drake_clusters": op12_drake_clusters,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {}

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""
ORACLE["op9_decontaminate"] = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, len, list_slice(w, s, s + len - 1) AS win FROM (
  SELECT item_id, w, least(len(w), 10) AS len, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len FROM bw),
dw AS (SELECT doc_id, s, len, list_slice(w, s, s + len - 1) AS win FROM (
  SELECT doc_id, w, len, unnest(generate_series(1, len(w) - len + 1)) AS s FROM d, lens WHERE len(w) >= len)),
m AS (SELECT doc_id, s, dw.len AS len, item_id FROM dw JOIN (SELECT DISTINCT * FROM bw) q ON dw.len = q.len AND dw.win = q.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + len - 1)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

ORACLE["op4_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS target FROM p GROUP BY html),
h AS (SELECT html, sha1(html) AS hex FROM g),
b AS (SELECT html, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> s) & 31 AS INTEGER) + 1, 1), '' ORDER BY i, s DESC) AS digest
  FROM (SELECT html, i, s, CAST('0x' || substr(hex, CAST(i * 5 + 1 AS INTEGER), 5) AS BIGINT) AS v FROM h, range(0, 8) r(i), (VALUES (15), (10), (5), (0)) q(s)) GROUP BY html)
SELECT page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = target THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = target THEN NULL ELSE target END AS refers_to
FROM p JOIN g USING (html) JOIN b USING (html)
"""
ORACLE["op7_bit_sliced"] = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q::DOUBLE[], b.q::DOUBLE[]) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0))
WHERE rank <= 20
"""
_SHINGLES = r"""(SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) END AS s
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents))"""
ORACLE["op5_near_dup"] = rf"""
WITH RECURSIVE d AS MATERIALIZED {_SHINGLES},
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM d),
l AS MATERIALIZED (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d JOIN (SELECT u, min(v) AS component_id FROM r GROUP BY u) c ON d.doc_id = c.u
"""
_MARKS = ["<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<s>", "</s>", "<|role|>", "<|says|>", "<|end|>", "<|image|>", "<|audio|>", "<|document|>", "<|file|>"]


def _escaped_length(x: str) -> str:
    """Length of a text plus one for each backslash and each control string, of which none overlap."""
    return f"(length({x}) + " + " + ".join(f"(length({x}) - length(replace({x}, '{m}', ''))) // {len(m)}" for m in ["\\", *_MARKS]) + ")"


ORACLE["op11_chat_format"] = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) v(conv_id, turn, role, text))),
s AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
  sum({_escaped_length("text")} + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 23 + {_escaped_length("role")} END) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM s
"""


def _kmeans_sql(dims: int = 64, clusters: int = 8, rounds: int = 10) -> str:
    """The rounds one after another; distances are whole numbers, exact as doubles."""
    nearest = """SELECT r, arg_min(c, d * 8 + c) AS c, min(d) AS d FROM (
  SELECT v.r, c.c, CAST(list_dot_product(v.x, v.x) - 2 * list_dot_product(v.x, c.q::DOUBLE[]) + list_dot_product(c.q::DOUBLE[], c.q::DOUBLE[]) AS BIGINT) AS d FROM v, {c} c) GROUP BY r"""
    sql = rf"""WITH k AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, q, q::DOUBLE[] AS x FROM k),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, q) - 1 AS c, q FROM (SELECT sha256('3:' || vec_id) AS h, q FROM v WHERE vec_id IS NOT NULL ORDER BY h, q LIMIT {clusters}))"""
    for t in range(rounds):
        sql += rf""",
a{t} AS MATERIALIZED ({nearest.format(c=f"c{t}")}),
s{t} AS (SELECT a.c, i, sum(v.q[i]) AS s, count(*) AS n FROM a{t} a JOIN v USING (r), range(1, {dims + 1}) t(i) GROUP BY a.c, i),
m{t} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS q FROM s{t} GROUP BY c),
c{t + 1} AS MATERIALIZED (SELECT c.c, coalesce(m.q, c.q) AS q FROM c{t} c LEFT JOIN m{t} m USING (c))"""
    return sql + rf""",
f AS MATERIALIZED ({nearest.format(c=f"c{rounds}")})
SELECT vec_id, CAST(f.c AS INTEGER) AS cluster, f.d AS distance, CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256 FROM f JOIN v USING (r) JOIN c{rounds} c ON f.c = c.c
"""


ORACLE["op12_drake_clusters"] = _kmeans_sql()
