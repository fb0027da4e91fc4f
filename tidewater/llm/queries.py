"""One query per corpus operator, over whole tables, and the SQL for those that SQL can
express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import (
    alignment,
    decontaminate,
    extraction,
    jaccard_join,
    langid,
    licenses,
    packing,
    repeats,
    sharding,
    simhash_join,
    spelling,
    topk_search,
    warc,
)
from tidewater.session import shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op2_best_two_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.where(~out))
    return (langid.identify(docs.select("doc_id", "text"), model)
            .select("doc_id", out.alias("held_out"), "lang_pred", "score"))


@_query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (jaccard_join.classes(_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


ORACLE["op9_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM shingles),
items AS (SELECT doc_id, unnest(s) AS x FROM shingles),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= 80 * (p.n + q.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.node)
SELECT s.doc_id, CAST(s.n AS BIGINT) AS n_shingles, min(r.node) AS component_id
FROM sizes s JOIN reach r ON r.doc_id = s.doc_id GROUP BY s.doc_id, s.n
"""


@_query
def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(_table(spark, sf_dir, "documents"),
                              _table(spark, sf_dir, "benchmark"))


@_query
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(_table(spark, sf_dir, "documents"), 400)


@_query
def op3_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(warc.with_revisits(_table(spark, sf_dir, "pages"), 0), path)
    return warc.read(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op3_warc_boundary_chain"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, """ + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {10 * i + 1}, 10)"
    f" AS BIGINT) >> {5 * (7 - j)}) & 31 AS BIGINT) + 1, 1)"
    for i in range(4) for j in range(8)) + """ AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM p
"""


@_query
def op7_vector_bin_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents"), 16).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op1_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return topk_search.search(rows, rows.where(F.col("vec_id") % 50 == 0), 5, 256)


ORACLE["op1_maxscore_topk"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([p[1] * p[2] FOR p IN [[a, q.e[i]] FOR a, i IN c.e]]) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


@_query
def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


ORACLE["op4_license_digests"] = licenses.oracle()


@_query
def op8_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(_table(spark, sf_dir, "pages"))


@_query
def op11_simhash_popcount_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.classes(_table(spark, sf_dir, "documents"))


@_query
def op12_diagonal_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = alignment.align_and_score(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      "groups_sha256")


@_query
def op13_qchunk_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_table(spark, sf_dir, "documents"))


# DuckDB's levenshtein compares bytes, so the letters beyond ASCII get single bytes first.
_BEYOND = "".join(map(chr, range(0xC0, 0x100)))
_SINGLE = "".join(c for c in map(chr, range(32, 127)) if not c.islower() and c != "'")[:64]

ORACLE["op13_qchunk_spelling_variants"] = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS w
  FROM documents),
found AS (
  SELECT w, count(*) AS c, flatten([CASE WHEN unicode(x) < 128 THEN [unicode(x)]
      ELSE [192 | (unicode(x) >> 6), 128 | (unicode(x) & 63)] END
    FOR x IN string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, '')]) AS bytes
  FROM runs WHERE length(w) >= 7 GROUP BY doc_id, w),
hashed AS (
  SELECT w, c, xor(4294967295, list_reduce([CAST(b AS BIGINT) FOR b IN bytes], lambda s, b:
    xor(s >> 8, t[(xor(s, b) & 255) + 1]), 4294967295)) AS h FROM found, crc_table),
v AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 31 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2)
      ELSE w END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
cut AS (
  SELECT DISTINCT word, n, unnest(list_append(
    [substr(word, 1, i) || substr(word, i + 2) FOR i IN range(length(word))], word)) AS rest FROM v),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest
  WHERE levenshtein(translate(a.word, '{_BEYOND}', '{_SINGLE}'),
                    translate(b.word, '{_BEYOND}', '{_SINGLE}')) = 1),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS form_n,
    list(other ORDER BY n DESC, other)[1] AS form FROM near GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN form_n >= 10 * v.n THEN form END AS form,
    CASE WHEN form_n >= 10 * v.n THEN form_n END AS form_n
  FROM v LEFT JOIN best ON best.word = v.word),
steps(word, root, k) AS (
  SELECT word, word, 0 FROM f
  UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN f ON f.word = s.root
  WHERE f.form IS NOT NULL)
SELECT f.word, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form, f.form_n, r.root
FROM f JOIN (SELECT word, arg_max(root, k) AS root FROM steps GROUP BY word) r ON r.word = f.word
"""
