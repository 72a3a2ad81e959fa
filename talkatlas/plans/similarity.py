"""Registered queries: vectors, stores, recommendation, neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.functions import vector as V
from talkatlas.functions.sampling import is_train
from talkatlas.operators import classify as C
from talkatlas.operators import embed as E
from talkatlas.operators import inverted as I
from talkatlas.operators import recommend as R
from talkatlas.operators.knn import nearest
from talkatlas.operators.split import random_row_per_group, with_fold
from talkatlas.plans.common import DIM, VECTORS, Query, vectors
from talkatlas.plans.tables import bucket_sql
from talkatlas.session import scratch_path
from talkatlas.sources import files
from talkatlas.sources import vectors as VS

QUERY_ID = 7


def _total(v: str):
    return F.round(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double")), 6)


def vector_store_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors keyed by a title many rows share, written and read back."""
    path = scratch_path(spark, "vector-store")
    titled = vectors(spark, sf_dir).withColumn("title", F.concat(F.lit("v "), F.col("category").cast("string")))
    VS.write_store(titled, path, "title", "embedding", "vec_id")
    return VS.read_store(spark, path).select(
        "title", F.round(V.l2_norm(F.col("embedding")), 6).alias("norm"), _total("embedding").alias("total")
    )


def vector_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors saved as CSV text, read back and parsed."""
    path = scratch_path(spark, "vector-text")
    files.write_csv(vectors(spark, sf_dir).select("vec_id", V.vector_to_text(F.col("embedding")).alias("s")), path)
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("s", T.StringType())])
    parsed, _ = VS.parse_vectors(files.read_csv(spark, path, schema), "s", DIM)
    return parsed.select("vec_id", _total("embedding").alias("total"))


def _vector_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as text; category 9 lacks a value and category 8 holds one that is no number."""
    values = F.transform(
        "embedding", lambda x: F.concat(F.round(x.cast("double") * 10000).cast("bigint").cast("string"), F.lit("e-4"))
    )
    faulty = (
        F.when(F.col("category") == 9, F.slice(values, 1, DIM - 1))
        .when(F.col("category") == 8, F.concat(F.array(F.lit("x")), F.slice(values, 2, DIM - 1)))
        .otherwise(values)
    )
    return vectors(spark, sf_dir).select("vec_id", V.vector_to_text(faulty).alias("s"))


def vector_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = VS.parse_vectors(_vector_text(spark, sf_dir), "s", DIM)
    return parsed.select("vec_id", _total("embedding").alias("total"))


def vector_text_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = VS.parse_vectors(_vector_text(spark, sf_dir), "s", DIM)
    return rejected.select("vec_id", "s")


def vector_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dot product, norm and cosine of every vector and its own reverse."""
    v, r = F.col("embedding"), F.reverse("embedding")
    return vectors(spark, sf_dir).select(
        "vec_id",
        F.round(V.dot(v, r), 6).alias("dot"),
        F.round(V.l2_norm(v), 6).alias("norm"),
        F.round(V.cosine(v, r), 6).alias("cosine"),
    )


def cosine_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir)
    scored = R.cosine_scores(v, v.where(F.col("vec_id") == QUERY_ID), "embedding")
    return scored.select("vec_id", "sim").orderBy("vec_id")


def recommend_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.recommend(vectors(spark, sf_dir), "vec_id", QUERY_ID, "embedding").select("vec_id", "category", "sim")


def recommend_random_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For one random query per category, its nearest rows of the whole table."""
    v = vectors(spark, sf_dir)
    queries = v.join(random_row_per_group(v, "vec_id", "category").select("vec_id"), "vec_id", "left_semi")
    found = nearest(
        queries, v, 9, row_id="vec_id", vector="embedding", dim=DIM, query_columns=("category",), columns=("category",)
    )
    return found.withColumnRenamed("score", "sim")


def recommend_topk_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.recommend_all(vectors(spark, sf_dir), "vec_id", "embedding", DIM, "category")


def _index(spark: SparkSession, sf_dir: str) -> I.Index:
    path = scratch_path(spark, "vector-index")
    I.build_index(vectors(spark, sf_dir), path, row_id="vec_id", vector="embedding", dim=DIM, columns=("category",))
    return I.open_index(spark, path, row_id="vec_id", dim=DIM, columns=("category",))


def recommend_topk_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact neighbours of every row, from the cells of a stored index that can hold them."""
    found, _ = I.exact(_index(spark, sf_dir), vectors(spark, sf_dir), 9, vector="embedding", query_columns=("category",))
    return found.withColumnRenamed("score", "sim")


def recommend_topk_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate neighbours of every row from the lists that a recall of 0.95 takes, with the audited recall."""
    index, v = _index(spark, sf_dir), vectors(spark, sf_dir)
    probes, recall = I.tuned_probes(index, v, 9, vector="embedding")
    found = I.probe(index, v, 9, vector="embedding", probes=probes, query_columns=("category",))
    return found.withColumnRenamed("score", "sim").withColumn("recall", F.lit(recall))


def _faulty_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of five categories made unusable, each in its own way; the other categories are sound."""
    v = vectors(spark, sf_dir)
    whole = F.col("embedding").cast("array<double>")
    tail = F.slice(whole, 2, DIM - 1)
    faulty = whole
    for category, value in ((9, F.lit(None).cast("double")), (8, F.lit(float("nan"))), (7, F.lit(float("inf")))):
        faulty = F.when(F.col("category") == category, F.concat(F.array(value), tail)).otherwise(faulty)
    faulty = F.when(F.col("category") == 6, tail).otherwise(faulty)
    return v.withColumn("embedding", faulty).withColumn("vec_id", F.when(F.col("category") != 5, F.col("vec_id")))


def recommend_faulty_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of every sound row among the sound rows; the others take no part."""
    return R.recommend_all(_faulty_vectors(spark, sf_dir), "vec_id", "embedding", DIM, "category", k=4)


def neighbour_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.neighbour_hits(recommend_topk_all(spark, sf_dir), "vec_id", "category")


def hit_rate_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = R.recommend_all(vectors(spark, sf_dir), "vec_id", "embedding", DIM, "category", k=2)
    return R.hit_rate(top, "category").withColumn("hit_rate", F.round("hit_rate", 6))


def pool_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a category as the token vectors of one text."""
    pooled = E.pool_mean(vectors(spark, sf_dir), "category", "embedding")
    values = pooled.select("category", F.posexplode("embedding").alias("dim", "value"))
    return values.select("category", F.col("dim").cast("bigint").alias("dim"), F.round("value", 6).alias("value"))


def pool_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = E.pool_last(vectors(spark, sf_dir), "category", "vec_id", "embedding")
    values = pooled.select("category", F.posexplode("embedding").alias("dim", "value"))
    rounded = F.round(F.col("value").cast("double"), 6)
    return values.select("category", F.col("dim").cast("bigint").alias("dim"), rounded.alias("value"))


def classify_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = vectors(spark, sf_dir)
    chosen = is_train(F.col("vec_id"))
    return C.knn_classify(
        v.where(chosen), v.where(~chosen), 5, row_id="vec_id", vector="embedding", dim=DIM, label="category",
        metric="euclidean",
    )


def knn_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = with_fold(vectors(spark, sf_dir).where(is_train(F.col("vec_id"))), "vec_id")
    grid = C.knn_grid(train, row_id="vec_id", vector="embedding", dim=DIM, label="category")
    return grid.withColumn("avg_metric", F.round("avg_metric", 6))


# --- SQL twins -------------------------------------------------------------------

_NORMED = f"(SELECT *, sqrt(list_inner_product(embedding, embedding)) AS norm FROM {VECTORS})"
_SIM = """round(CASE WHEN q.norm * v.norm = 0 THEN 0 ELSE
  list_inner_product(q.embedding, v.embedding) / (q.norm * v.norm) END, 6)"""
_PAIRS = f"""pairs AS (
  SELECT q.vec_id AS query_vec_id, q.category AS query_category, v.vec_id, v.category, {_SIM} AS sim
  FROM n q JOIN n v ON q.vec_id <> v.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_vec_id ORDER BY sim DESC, vec_id) AS rank FROM pairs)"""
_RANKED = f"WITH n AS {_NORMED}, {_PAIRS}"
_TOTAL = "round(list_sum(list_transform({}, lambda x: x::DOUBLE)), 6)"
_VALUES = "list_transform(embedding, lambda x: round(x * 10000)::BIGINT || 'e-4')"
_TEXT = f"""texts AS (
  SELECT vec_id, '[array([' || array_to_string(CASE category WHEN 9 THEN list_slice({_VALUES}, 1, {DIM - 1})
    WHEN 8 THEN list_concat(['x'], list_slice({_VALUES}, 2, {DIM})) ELSE {_VALUES} END, ', ')
    || '],' || chr(10) || '      dtype=float32)]' AS s FROM {VECTORS}),
parsed AS (
  SELECT vec_id, s, list_transform(string_split(regexp_extract(regexp_replace(replace(s, ' dtype=float32', ''),
    '\\s', '', 'g'), '^\\[array\\(\\[(.*)\\],?\\)\\]$', 1), ','), lambda x: try_cast(x AS FLOAT)) AS v FROM texts),
checked AS (
  SELECT *, len(v) = {DIM} AND len(list_filter(v, lambda x: x IS NULL)) = 0 AS good FROM parsed)"""
_DISTANCE = "round(sqrt(list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda p: (p[1] - p[2]) ** 2))), 6)"
_SPLIT = f"(SELECT *, {bucket_sql('vec_id', 10, 42)} < 8 AS is_train, {bucket_sql('vec_id', 5, 7)} AS fold FROM {_NORMED})"

QUERIES: dict[str, Query] = {
    "vector_store_last_wins": Query(
        vector_store_last_wins,
        f"""SELECT title, round(sqrt(list_inner_product(e, e)), 6) AS norm, {_TOTAL.format('e')} AS total
        FROM (SELECT 'v ' || category AS title, max_by(embedding, vec_id) AS e FROM {VECTORS} GROUP BY 1)""",
    ),
    "vector_text_roundtrip": Query(
        vector_text_roundtrip, f"SELECT vec_id, {_TOTAL.format('embedding')} AS total FROM {VECTORS}"
    ),
    "vector_text_parse": Query(
        vector_text_parse, f"WITH {_TEXT} SELECT vec_id, {_TOTAL.format('v')} AS total FROM checked WHERE good"
    ),
    "vector_text_rejects": Query(vector_text_rejects, f"WITH {_TEXT} SELECT vec_id, s FROM checked WHERE NOT good"),
    "vector_ops": Query(
        vector_ops,
        f"""SELECT vec_id, round(list_inner_product(embedding, r), 6) AS dot, round(norm, 6) AS norm,
          round(CASE WHEN norm = 0 THEN 0 ELSE list_inner_product(embedding, r) / (norm * norm) END, 6) AS cosine
        FROM (SELECT *, list_reverse(embedding) AS r FROM {_NORMED})""",
    ),
    "cosine_scores": Query(
        cosine_scores,
        f"WITH n AS {_NORMED} SELECT v.vec_id, {_SIM} AS sim FROM n v JOIN n q ON q.vec_id = {QUERY_ID}",
    ),
    "recommend_topk": Query(
        recommend_topk, f"{_RANKED} SELECT vec_id, category, sim FROM ranked WHERE query_vec_id = {QUERY_ID} AND rank <= 9"
    ),
    "recommend_random_query": Query(
        recommend_random_query,
        f"""{_RANKED}, picked AS (
          SELECT vec_id, row_number() OVER (PARTITION BY category ORDER BY md5('42:' || vec_id), vec_id) AS pick FROM n)
        SELECT * FROM ranked WHERE rank <= 9 AND query_vec_id IN (SELECT vec_id FROM picked WHERE pick = 1)""",
    ),
    "recommend_topk_all": Query(recommend_topk_all, f"{_RANKED} SELECT * FROM ranked WHERE rank <= 9"),
    "recommend_topk_pivot": Query(recommend_topk_pivot, f"{_RANKED} SELECT * FROM ranked WHERE rank <= 9"),
    "recommend_topk_index": Query(recommend_topk_index),
    "recommend_faulty_vectors": Query(
        recommend_faulty_vectors,
        f"WITH n AS (SELECT * FROM {_NORMED} WHERE category < 5), {_PAIRS} SELECT * FROM ranked WHERE rank <= 3",
    ),
    "neighbour_hits": Query(
        neighbour_hits,
        f"""{_RANKED} SELECT query_vec_id, query_category, count(*) AS n_neighbours,
          count(*) FILTER (WHERE category = query_category) AS n_hits FROM ranked WHERE rank <= 9 GROUP BY 1, 2""",
    ),
    "hit_rate_top1": Query(
        hit_rate_top1,
        f"""{_RANKED} SELECT query_category AS category, count(*) AS n_queries,
          round(avg((category = query_category)::INT), 6) AS hit_rate FROM ranked WHERE rank = 1 GROUP BY 1""",
    ),
    "pool_mean": Query(
        pool_mean,
        f"""SELECT category, dim, round(avg(value), 6) AS value FROM (
          SELECT category, unnest(range(len(embedding))) AS dim, unnest(embedding) AS value FROM {VECTORS}) GROUP BY 1, 2""",
    ),
    "pool_last": Query(
        pool_last,
        f"""SELECT category, unnest(range(len(e))) AS dim, round(unnest(e), 6) AS value FROM (
          SELECT category, max_by(embedding, vec_id) AS e FROM {VECTORS} GROUP BY 1)""",
    ),
    "classify_knn": Query(
        classify_knn,
        f"""WITH s AS {_SPLIT}, d AS (
          SELECT q.vec_id, q.category, v.category AS vote, row_number() OVER (
            PARTITION BY q.vec_id ORDER BY {_DISTANCE}, v.vec_id) AS rank
          FROM s q JOIN s v ON NOT q.is_train AND v.is_train),
        votes AS (SELECT vec_id, category, vote, count(*) AS n FROM d WHERE rank <= 5 GROUP BY 1, 2, 3),
        best AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, vote) AS r FROM votes)
        SELECT vec_id, category, vote AS prediction FROM best WHERE r = 1""",
    ),
    "knn_grid": Query(
        knn_grid,
        f"""WITH s AS {_SPLIT}, p AS (
          SELECT q.vec_id, q.category, q.fold, v.vec_id AS other, v.category AS vote, {_DISTANCE} AS distance, {_SIM} AS sim
          FROM s q JOIN s v ON q.is_train AND v.is_train AND q.fold <> v.fold),
        d AS (
          SELECT *, 'euclidean' AS metric, row_number() OVER (PARTITION BY vec_id ORDER BY distance, other) AS rank FROM p
          UNION ALL
          SELECT *, 'cosine', row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, other) FROM p),
        votes AS (
          SELECT k, metric, vec_id, category, fold, vote, count(*) AS n
          FROM d JOIN (VALUES (5::BIGINT), (10::BIGINT), (15::BIGINT)) ks(k) ON rank <= k GROUP BY ALL),
        best AS (SELECT *, row_number() OVER (PARTITION BY k, metric, vec_id ORDER BY n DESC, vote) AS r FROM votes),
        folds AS (SELECT k, metric, fold, avg((vote = category)::INT) AS accuracy FROM best WHERE r = 1 GROUP BY ALL)
        SELECT k, metric, round(avg(accuracy), 6) AS avg_metric FROM folds GROUP BY ALL""",
    ),
}
