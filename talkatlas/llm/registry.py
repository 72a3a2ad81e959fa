"""Registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.llm import (
    boilerplate,
    bpe,
    embedding,
    filters,
    fingerprints,
    language,
    negatives,
    packing,
    quality,
    simhash,
    suffixes,
    warc,
    windows,
)
from talkatlas.llm.tables import table
from talkatlas.session import scratch_path

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
Run = Callable[[SparkSession, str], DataFrame]


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_chunks(spark, path, with_bytes=False)).drop("record")


def op3_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), with_ids=False)


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, sf_dir, "documents")).drop("digest")


def op9_boilerplate(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = boilerplate.without_boilerplate(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.removals(table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, e, sqrt(list_inner_product(e, e)) AS norm
  FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    AND a.norm > 0 AND b.norm > 0 AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(least(vec_id, b), vec_id) AS component_id,
  vec_id <= coalesce(b, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN least ON least.a = vec_id
"""

OP5_SQL = r"""
WITH t AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS first_copy,
    list_filter(string_split_regex(text, '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
spots AS (
  SELECT doc_id, s, md5(array_to_string(list_slice(w, s + 1, s + 50), ' ')) AS words
  FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS s FROM t WHERE doc_id = first_copy AND len(w) >= 50)),
firsts AS (SELECT doc_id, s, first_value({'d': doc_id, 's': s}) OVER (PARTITION BY words ORDER BY doc_id, s) AS f FROM spots),
again AS (
  SELECT doc_id, s, f.d AS source, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50, true) AS opens
  FROM firsts WHERE {'d': doc_id, 's': s} <> f),
spans AS (SELECT doc_id, s, source, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY s) AS span FROM again)
SELECT doc_id, min(s)::BIGINT AS start_word, (max(s) + 50 - min(s))::BIGINT AS n_words, min(source)::BIGINT AS first_doc_id
FROM spans GROUP BY doc_id, span
UNION ALL
SELECT doc_id, 0::BIGINT, len(w)::BIGINT, first_copy FROM t WHERE doc_id <> first_copy AND len(w) >= 50
"""

OP9_SQL = r"""
WITH t AS (SELECT doc_id, source, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, source, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no FROM t),
found AS (SELECT line, min({'a': doc_id, 'b': line_no}) AS first FROM l
          WHERE regexp_matches(line, '[\p{L}\p{N}]') GROUP BY line HAVING count(DISTINCT source) >= 10),
gone AS (SELECT doc_id, list(line_no) AS gone
         FROM l JOIN found USING (line) WHERE {'a': doc_id, 'b': line_no} <> first GROUP BY doc_id)
SELECT doc_id, len(ls)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(ls, lambda x, i: NOT list_contains(coalesce(gone, []), i - 1)), chr(10)))
         AS kept_sha256
FROM t LEFT JOIN gone USING (doc_id)
"""

OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER best <= 10
"""

OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, part, t, doc_id > min(doc_id) OVER (PARTITION BY t) AS copy,
    list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS w,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS capitals FROM d),
f AS (
  SELECT part, doc_id, concat(
    CASE WHEN len(w) < 50 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' END,
    CASE WHEN 100 * capitals > 5 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN copy THEN 'E' END) AS fails FROM m),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own, string_split(filter_order[1:step - 1], '') AS earlier
      FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, own, n, good, toxic, fails, contains(fails, own) AS bad,
        len(list_filter(earlier, lambda e: e <> '' AND contains(fails, e))) > 0 AS gone FROM c, s),
a AS (
  SELECT part, filter_order, step, own, coalesce(sum(n) FILTER (NOT gone AND NOT bad), 0) AS kept,
    coalesce(sum(n) FILTER (NOT gone AND bad), 0) AS removed, coalesce(sum(n) FILTER (gone AND bad), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = own), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND bad), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (NOT gone AND bad), 0) AS toxic_lost FROM r GROUP BY part, filter_order, step, own)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
  redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
  toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM a
"""

OP13_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
spots AS (
  SELECT doc_id, s, md5(array_to_string(list_slice(w, s + 1, s + 50), ' ')) AS words
  FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS s FROM t WHERE len(w) >= 50)),
again AS (SELECT doc_id, s FROM spots QUALIFY doc_id > min(doc_id) OVER (PARTITION BY words)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS k FROM again),
left_over AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS k FROM t) ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM t LEFT JOIN left_over USING (doc_id)
"""


QUERIES: dict[str, Run] = {
    "op1_quality": op1_quality,
    "op2_warc": op2_warc,
    "op3_embedding": op3_embedding,
    "op4_bpe": op4_bpe,
    "op5_suffixes": op5_suffixes,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_language": op8_language,
    "op9_boilerplate": op9_boilerplate,
    "op10_fingerprints": op10_fingerprints,
    "op11_negatives": op11_negatives,
    "op12_filters": op12_filters,
    "op13_windows": op13_windows,
}
SQL: dict[str, str] = {
    "op3_embedding": OP3_SQL,
    "op5_suffixes": OP5_SQL,
    "op9_boilerplate": OP9_SQL,
    "op11_negatives": OP11_SQL,
    "op12_filters": OP12_SQL,
    "op13_windows": OP13_SQL,
}
