"""Registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, lexical, lines, minhash, mtree, packing, passages, pii, quality, token_files, warc, wrappers
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


ORACLE["op9_quality_rules"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rn, doc_id, t,
         list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), tri AS (
  SELECT rn, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3
), key AS (
  SELECT rn, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM tri
), rep AS (
  SELECT rn, i FROM key QUALIFY count(*) OVER (PARTITION BY rn, a, b, c) > 1
), cover AS (
  SELECT rn, count(DISTINCT p) AS n FROM (
    SELECT rn, i AS p FROM rep UNION ALL SELECT rn, i + 1 FROM rep UNION ALL SELECT rn, i + 2 FROM rep)
  GROUP BY rn
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(cover.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines,
         len(list_filter(ls, lambda x: ends_with(rtrim(x, ' '), '...'))) AS n_ell,
         length(regexp_replace(t, '\P{L}+', '', 'g')) AS letters,
         length(regexp_replace(t, '\P{Lu}+', '', 'g')) AS uppers
  FROM w LEFT JOIN cover ON w.rn = cover.rn
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > 0.1::DOUBLE * n_words OR n_dup_lines > 0.5::DOUBLE * n_lines
            OR NOT (word_chars / greatest(n_words, 1) BETWEEN 2.5 AND 12.0)
            OR uppers > 0.5::DOUBLE * greatest(letters, 1) OR letters < 0.45::DOUBLE * word_chars
            OR n_ell > 0.5::DOUBLE * n_lines) AS kept
FROM b
"""


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode(table(spark, sf_dir, "documents", "doc_id", "text"), decoded=True)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wrappers.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return out.select(F.col("_cl_row.doc_id").alias("doc_id"), F.col("_cl_removed").alias("n_removed"),
                      F.coalesce("_cl_clean", F.lit("")).alias("text"))


ORACLE["op1_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, chr(0)) AS site,
         md5(coalesce(doc_id::VARCHAR, chr(2)) || chr(1) || coalesce(text, '')) AS k
  FROM documents
), l AS (
  SELECT k, site, unnest(range(len(string_split(t, chr(10))))) AS pos, unnest(string_split(t, chr(10))) AS line FROM d
), o AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM l
), b AS (
  SELECT x, min((k, pos)) AS first FROM o WHERE x <> '' GROUP BY x HAVING count(DISTINCT site) >= 5
), g AS (
  SELECT DISTINCT o.k, o.pos FROM o JOIN b ON o.x = b.x WHERE (o.k, o.pos) <> b.first
), kept AS (
  SELECT k, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM (SELECT DISTINCT l.k, l.pos, l.line FROM l ANTI JOIN g ON l.k = g.k AND l.pos = g.pos) GROUP BY k
), n AS (
  SELECT k, count(*) AS n FROM g GROUP BY k
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_removed, coalesce(kept.text, '') AS text
FROM d LEFT JOIN kept ON d.k = kept.k LEFT JOIN n ON d.k = n.k
"""


@query
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "class_id", "keep")


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = mtree.prepared(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return mtree.top_k(vectors, F.col("vec_id") % 20 == 0, 20)


ORACLE["op4_exact_top_k"] = r"""
WITH v AS (
  SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rn, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.rn <> c.rn WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY rn ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages", "page_id", "url", "html")))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(table(spark, sf_dir, "documents", "doc_id", "text")))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.report(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


ORACLE["op12_lexical_search"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rn, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), q AS (
  SELECT row_number() OVER () AS qn, item_id,
         list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS words
  FROM benchmark
), s AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM d WHERE len(words) > 0
), t AS (
  SELECT rn, term, count(*)::BIGINT AS tf FROM (SELECT rn, unnest(words) AS term FROM d) GROUP BY rn, term
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, s GROUP BY term, n_docs
), m AS (
  SELECT rn, doc_id, 100 - 50 + (50 * len(words)::BIGINT * n_docs) // n_terms AS m FROM d, s WHERE len(words) > 0
), r AS (
  SELECT q.qn, q.item_id, m.rn, m.doc_id, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * m.m)))::BIGINT AS score
  FROM (SELECT qn, item_id, unnest(words) AS term FROM q) q JOIN t ON q.term = t.term JOIN w ON w.term = t.term JOIN m ON m.rn = t.rn
  GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY qn ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM r WHERE score > 0 QUALIFY rank <= 50
"""
