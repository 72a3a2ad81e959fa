"""Registered queries: TF-IDF, chunks, summaries, text embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.operators import chunking as K
from talkatlas.operators import embed as E
from talkatlas.operators import features as X
from talkatlas.operators import summarise as Z
from talkatlas.operators import term_index as TI
from talkatlas.operators import tfidf as I
from talkatlas.operators.recommend import recommend_by_terms
from talkatlas.operators.split import random_row_per_group
from talkatlas.plans.common import TRANSCRIPTS, Query, spread_transcripts, transcripts
from talkatlas.plans.tables import TOKENS_SQL, _token_counts
from talkatlas.session import scratch_path

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def tfidf_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(I.tfidf_l2(spread_transcripts(spark, sf_dir), "doc_id", "transcript"), "weight")


def tfidf_unsmoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = I.tfidf_unsmoothed(spread_transcripts(spark, sf_dir), "doc_id", "transcript")
    return _rounded(weights, "weight").select("doc_id", "term", "tf", "df", "weight")


def recommend_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend_by_terms(spread_transcripts(spark, sf_dir), "doc_id", "transcript", "category")


def _term_search(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The queries of ``recommend_tfidf``, and what a stored term index finds for them at which effort."""
    path = scratch_path(spark, "term-index")
    TI.build_term_index(spread_transcripts(spark, sf_dir), path, "doc_id", "transcript")
    picked = random_row_per_group(transcripts(spark, sf_dir), "doc_id", "category")
    queries = picked.select(F.col("category").alias("query_category"), F.col("doc_id").alias("query_id"))
    return queries, *TI.search(TI.open_term_index(spark, path, "doc_id"), queries, 9)


def recommend_tfidf_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, found, _ = _term_search(spark, sf_dir)
    return found.join(queries, "query_id")


def _bucket_totals(spark: SparkSession, sf_dir: str, vector: str) -> DataFrame:
    """Sum of a hashed vector per category, in long form."""
    docs = spread_transcripts(spark, sf_dir).dropna(subset=["transcript"])
    vectors = X.fit_tfidf(docs, "transcript").transform(docs)
    sums = vectors.groupBy("category").agg(vector_to_array(Summarizer.sum(F.col(vector))).alias("total"))
    totals = sums.select("category", F.posexplode("total").alias("bucket", "total")).where(F.col("total") != 0)
    return totals.select("category", F.col("bucket").cast("bigint").alias("bucket"), F.round("total", 6).alias("total"))


def hashing_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_totals(spark, sf_dir, "tf")


def tfidf_spark_ml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bucket_totals(spark, sf_dir, "tfidf")


def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_plan(_token_counts(spark, sf_dir), "doc_id", "n_tokens")


def chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.chunk_text(spread_transcripts(spark, sf_dir), "doc_id", "transcript")


def chunk_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.concat_chunks(chunk_text(spark, sf_dir), "doc_id", "chunk_ix", "chunk_text", "text")


def summarise_extractive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.summarise(spread_transcripts(spark, sf_dir), "doc_id", "transcript")


def summarise_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.summarise_sample(spread_transcripts(spark, sf_dir), "doc_id", "transcript", 10)


def word_tally_model():
    """Stand-in for a caller's model: the number of words of each chunk."""

    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array([f"{len(t.split())} words" for t in texts], dtype=object)

    return predict


def summarise_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_transcripts(spark, sf_dir)
    return Z.summarise_with_model(docs, "doc_id", "transcript", word_tally_model, sep="; ")


def summary_cost_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = Z.cost_table(spread_transcripts(spark, sf_dir), "doc_id", "transcript")
    return cost.agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_chunks").alias("n_chunks"),
        F.round(F.avg("n_chunks"), 6).alias("mean_chunks"),
        F.min("budget").alias("min_budget"),
    )


def letter_model():
    """Stand-in for a caller's model: how often each letter occurs."""
    letters = LETTERS

    def predict(texts: np.ndarray) -> np.ndarray:
        return np.array([[t.count(c) for c in letters] for t in texts], dtype=np.float32)

    return predict


def embed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread_transcripts(spark, sf_dir).select("doc_id", "transcript")
    embedded = E.embed_batch(docs, "transcript", letter_model, len(LETTERS)).select("doc_id", F.posexplode("embedding"))
    return embedded.select("doc_id", F.col("pos").cast("bigint").alias("dim"), F.col("col").cast("double").alias("value"))


def embed_word2vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.embed_word2vec(spread_transcripts(spark, sf_dir), "doc_id", "transcript", dim=32)


def embed_hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that is not zero."""
    embedded = E.embed_hashed(spread_transcripts(spark, sf_dir), "doc_id", "transcript")
    values = embedded.select("doc_id", F.posexplode("embedding").alias("dim", "value")).where("value <> 0")
    return values.select("doc_id", F.col("dim").cast("bigint").alias("dim"), "value")


# --- SQL twins -------------------------------------------------------------------

_POSTINGS = r"""counts AS (
  SELECT doc_id, term, count(*) AS tf FROM (
    SELECT doc_id, unnest(regexp_extract_all(lower(transcript), '[\p{L}\p{N}_]{2,}')) AS term FROM {source})
  GROUP BY 1, 2),
freq AS (SELECT term, count(*) AS df FROM counts GROUP BY 1),
raw AS (
  SELECT doc_id, counts.term, tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS w
  FROM counts JOIN freq ON counts.term = freq.term, (SELECT count(*) AS n FROM {source})),
weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


def _postings(source: str) -> str:
    return _POSTINGS.replace("{source}", source)


_CHUNKS = r"""tokens AS (
  SELECT doc_id, ts, len(ts)::BIGINT AS n, greatest(1, (len(ts) + 499) // 500)::BIGINT AS c
  FROM (SELECT doc_id, regexp_extract_all(lower(transcript), '[\p{L}\p{N}_]+') AS ts FROM {source})),
chunks AS (
  SELECT doc_id, ts, c, ix AS chunk_ix, ix * (n // c) + least(ix, n % c) AS chunk_start,
    n // c + (ix < n % c)::BIGINT AS chunk_length, greatest(1, 500 // c)::BIGINT AS budget
  FROM (SELECT *, unnest(range(c)) AS ix FROM tokens))"""


def _chunks(source: str) -> str:
    return _CHUNKS.replace("{source}", source)


def _summary_sql(source: str) -> str:
    """Summaries of the rows of ``source`` with weights from all transcripts."""
    return f"""WITH {_postings(TRANSCRIPTS)}, {_chunks(source)},
    spans AS (
      SELECT doc_id, chunk_ix, budget, span_ix,
        list_slice(ts, chunk_start + span_ix * 20 + 1,
          chunk_start + least(span_ix * 20 + least(20, budget), chunk_length)) AS cut,
        list_slice(ts, chunk_start + span_ix * 20 + 1, chunk_start + least(span_ix * 20 + 20, chunk_length)) AS whole
      FROM (SELECT *, unnest(range((chunk_length + 19) // 20)) AS span_ix FROM chunks)),
    terms AS (
      SELECT DISTINCT doc_id, chunk_ix, span_ix, term
      FROM (SELECT doc_id, chunk_ix, span_ix, unnest(whole) AS term FROM spans)),
    scores AS (
      SELECT t.doc_id, chunk_ix, span_ix, round(sum(coalesce(weight, 0)), 6) AS score
      FROM terms t LEFT JOIN weights w ON t.doc_id = w.doc_id AND t.term = w.term GROUP BY ALL),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY doc_id, chunk_ix ORDER BY score DESC, span_ix) AS rank FROM scores),
    kept AS (
      SELECT s.doc_id, string_agg(array_to_string(cut, ' '), ' ' ORDER BY s.chunk_ix, s.span_ix) AS summary
      FROM ranked r JOIN spans s ON r.doc_id = s.doc_id AND r.chunk_ix = s.chunk_ix AND r.span_ix = s.span_ix
      WHERE rank <= greatest(1, budget // 20) GROUP BY 1)
    SELECT t.doc_id, coalesce(summary, '') AS summary FROM tokens t LEFT JOIN kept k ON t.doc_id = k.doc_id"""


def _mixed(k: str) -> str:
    a = f"(({k}) * 3432918353 % 4294967296)"
    return f"(xor({a} * 32768 % 4294967296, {a} // 131072) * 461845907 % 4294967296)"


def _step(h: str, k: str) -> str:
    x = f"xor({h}, {_mixed(k)})"
    return f"((xor({x} * 8192 % 4294967296, {x} // 524288) * 5 + 3864292196) % 4294967296)"


# The hash of the feature hasher (MurmurHash3, 32 bits, seed 42), spelled in SQL over the bytes of every different token.
_BUCKETS = f"""texts AS (
  SELECT doc_id, category, lower(transcript) AS t, regexp_replace(lower(transcript), '[ \t\n\x0B\f\r]+$', '') AS bare
  FROM {TRANSCRIPTS} WHERE transcript IS NOT NULL),
tokens AS (
  SELECT doc_id, category, token, count(*) AS tf FROM (
    SELECT doc_id, category, unnest(CASE WHEN bare = '' AND t <> '' THEN [] ELSE string_split_regex(bare, '[ \t\n\x0B\f\r]') END) AS token
    FROM texts) GROUP BY ALL),
bytes AS (SELECT token, hex(encode(token)) AS x, octet_length(encode(token)) AS n FROM (SELECT DISTINCT token FROM tokens)),
words AS (
  SELECT token, n, list_transform(range(n // 4), lambda i:
      ('0x' || x[8*i+7:8*i+8] || x[8*i+5:8*i+6] || x[8*i+3:8*i+4] || x[8*i+1:8*i+2])::UBIGINT) AS ws,
    CASE WHEN n % 4 = 0 THEN 0::UBIGINT ELSE ('0x' || CASE WHEN n % 4 = 3 THEN x[2*n-1:2*n] ELSE '' END
      || CASE WHEN n % 4 = 3 THEN x[2*n-3:2*n-2] WHEN n % 4 = 2 THEN x[2*n-1:2*n] ELSE '' END
      || x[8*(n//4)+1:8*(n//4)+2])::UBIGINT END AS tail FROM bytes),
h1 AS (SELECT token, n, tail, list_reduce(list_prepend(42::UBIGINT, ws), lambda h, k: {_step("h", "k")}) AS h FROM words),
h2 AS (SELECT token, xor(xor(h, {_mixed("tail")}), n::UBIGINT) AS h FROM h1),
h3 AS (SELECT token, xor(h, h // 65536) * 2246822507 % 4294967296 AS h FROM h2),
h4 AS (SELECT token, xor(h, h // 8192) * 3266489909 % 4294967296 AS h FROM h3),
h5 AS (SELECT token, xor(h, h // 65536)::BIGINT AS h FROM h4),
places AS (SELECT token, ((h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END) % 1000 + 1000) % 1000 AS bucket FROM h5),
hashed AS (SELECT doc_id, category, bucket, sum(tf) AS tf FROM tokens JOIN places USING (token) GROUP BY ALL)"""

_SAMPLE = f"(SELECT * FROM {TRANSCRIPTS} ORDER BY md5('42:' || doc_id), doc_id LIMIT 10)"
_LETTER_COUNTS = ", ".join(f"length(transcript) - length(replace(transcript, '{c}', ''))" for c in LETTERS)

_RECOMMEND_TFIDF = f"""WITH {_postings(TRANSCRIPTS)}, picked AS (
  SELECT category AS query_category, doc_id AS query_id,
    row_number() OVER (PARTITION BY category ORDER BY md5('42:' || doc_id), doc_id) AS pick
  FROM {TRANSCRIPTS} WHERE category IS NOT NULL),
q AS (SELECT query_category, query_id, term, weight AS qw FROM picked
  JOIN weights ON doc_id = query_id WHERE pick = 1),
shared AS (SELECT query_id, doc_id, sum(weight * qw) AS sim FROM q JOIN weights w ON q.term = w.term GROUP BY 1, 2),
scored AS (
  SELECT query_category, p.query_id, d.doc_id, round(coalesce(sim, 0), 6) AS sim
  FROM picked p JOIN documents d ON p.pick = 1 AND d.doc_id <> p.query_id
  LEFT JOIN shared s ON s.query_id = p.query_id AND s.doc_id = d.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_category ORDER BY sim DESC, doc_id) AS rank FROM scored)
SELECT * FROM ranked WHERE rank <= 9"""

QUERIES: dict[str, Query] = {
    "tfidf_l2": Query(
        tfidf_l2, f"WITH {_postings(TRANSCRIPTS)} SELECT doc_id, term, round(weight, 6) AS weight FROM weights"
    ),
    "tfidf_unsmoothed": Query(
        tfidf_unsmoothed,
        f"""WITH {_postings(TRANSCRIPTS)}
        SELECT doc_id, counts.term, tf, df, round(tf * ln((n + 1.0::DOUBLE) / (df + 1.0::DOUBLE)), 6) AS weight
        FROM counts JOIN freq ON counts.term = freq.term, (SELECT count(*) AS n FROM documents)""",
    ),
    "recommend_tfidf": Query(recommend_tfidf, _RECOMMEND_TFIDF),
    "recommend_tfidf_index": Query(recommend_tfidf_index, _RECOMMEND_TFIDF),
    "hashing_tf": Query(
        hashing_tf, f"WITH {_BUCKETS} SELECT category, bucket, sum(tf)::DOUBLE AS total FROM hashed GROUP BY ALL"
    ),
    "tfidf_spark_ml": Query(
        tfidf_spark_ml,
        f"""WITH {_BUCKETS}, weighed AS (
          SELECT category, bucket, tf * ln(((SELECT count(*) FROM texts) + 1) / (count(*) OVER (PARTITION BY bucket) + 1)) AS w FROM hashed)
        SELECT category, bucket, round(sum(w), 6) AS total FROM weighed GROUP BY ALL HAVING sum(w) <> 0""",
    ),
    "chunk_plan": Query(
        chunk_plan,
        f"WITH {_chunks(TRANSCRIPTS)} SELECT doc_id, chunk_ix, chunk_start, chunk_length, budget FROM chunks",
    ),
    "chunk_text": Query(
        chunk_text,
        f"""WITH {_chunks(TRANSCRIPTS)} SELECT doc_id, chunk_ix,
          array_to_string(list_slice(ts, chunk_start + 1, chunk_start + chunk_length), ' ') AS chunk_text FROM chunks""",
    ),
    "chunk_concat": Query(
        chunk_concat, f"WITH {_chunks(TRANSCRIPTS)} SELECT doc_id, array_to_string(ts, ' ') AS text FROM tokens"
    ),
    "summarise_extractive": Query(summarise_extractive, _summary_sql(TRANSCRIPTS)),
    "summarise_sample": Query(summarise_sample, _summary_sql(_SAMPLE)),
    "summarise_model": Query(
        summarise_model,
        f"""WITH {_chunks(TRANSCRIPTS)} SELECT doc_id, string_agg(chunk_length || ' words', '; ' ORDER BY chunk_ix) AS summary
        FROM chunks GROUP BY 1""",
    ),
    "summary_cost_stats": Query(
        summary_cost_stats,
        f"""SELECT sum(n)::BIGINT AS n_tokens, sum(c)::BIGINT AS n_chunks, round(avg(c), 6) AS mean_chunks,
          min(greatest(1, 500 // c))::BIGINT AS min_budget
        FROM (SELECT n, greatest(1, (n + 499) // 500)::BIGINT AS c
          FROM (SELECT {TOKENS_SQL}::BIGINT AS n FROM {TRANSCRIPTS}))""",
    ),
    "embed_batch": Query(
        embed_batch,
        f"""SELECT doc_id, unnest(range({len(LETTERS)})) AS dim, unnest([{_LETTER_COUNTS}])::DOUBLE AS value
        FROM {TRANSCRIPTS}""",
    ),
    "embed_word2vec": Query(embed_word2vec),
    "embed_hashed": Query(
        embed_hashed,
        f"""WITH digests AS (
          SELECT doc_id, md5(token) AS d FROM (
            SELECT doc_id, unnest(regexp_extract_all(lower(transcript), '[\\p{{L}}\\p{{N}}_]+')) AS token FROM {TRANSCRIPTS})),
        sums AS (
          SELECT doc_id, ('0x' || d[1:8])::BIGINT % 768 AS dim, sum(1 - 2 * (('0x' || d[9:16])::BIGINT % 2)) AS s
          FROM digests GROUP BY 1, 2)
        SELECT doc_id, dim, s / sqrt(sum(s * s) OVER (PARTITION BY doc_id)) AS value FROM sums QUALIFY s <> 0""",
    ),
}
