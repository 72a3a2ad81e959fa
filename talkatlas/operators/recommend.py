"""Recommendation by similarity and its hit rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.functions import vector as V
from talkatlas.operators.knn import DIGITS, nearest
from talkatlas.operators.ranking import top_per_group
from talkatlas.operators.skew import skew_join
from talkatlas.operators.split import random_row_per_group
from talkatlas.operators.tfidf import tfidf_l2
from talkatlas.session import cut


def cosine_scores(vectors: DataFrame, query: DataFrame, vector: str) -> DataFrame:
    """``sim`` of every row to the single row of ``query``; no join, no shuffle.

    The query vector and its norm are scalar subqueries, run once.
    """
    q = query.agg(F.first(vector).alias("_v")).select("_v", V.l2_norm(F.col("_v")).alias("_norm"))
    beside = vectors.withColumns({"_query": q.select("_v").scalar(), "_query_norm": q.select("_norm").scalar()})
    sim = V.cosine(F.col(vector), F.col("_query"), norm_b=F.col("_query_norm"))
    return beside.withColumn("sim", F.round(sim, DIGITS) + F.lit(0.0)).drop("_query", "_query_norm")


def recommend(vectors: DataFrame, row_id: str, query_id: int, vector: str, k: int = 10) -> DataFrame:
    """The ``k - 1`` rows most similar to row ``query_id``, which is itself left out.

    Rows with a NULL id, and vectors that are NULL, hold a value that is not finite or differ in width
    from the query's, take no part. An unknown ``query_id`` gives no rows.
    """
    sound = vectors.where(V.all_finite(F.col(vector)))
    query = sound.where(F.col(row_id) == query_id)
    width = query.agg(F.first(F.size(vector))).scalar()
    others = sound.where((F.col(row_id) != query_id) & (F.size(vector) == width))
    scored = cosine_scores(others, query, vector)
    return scored.orderBy(F.desc("sim"), F.asc(row_id)).limit(k - 1)


def recommend_all(vectors: DataFrame, row_id: str, vector: str, dim: int, category: str, k: int = 10) -> DataFrame:
    """The ``k - 1`` nearest rows of every row."""
    return nearest(
        vectors, vectors, k - 1, row_id=row_id, vector=vector, dim=dim, query_columns=(category,), columns=(category,)
    ).withColumnRenamed("score", "sim")


def neighbour_hits(recommended: DataFrame, row_id: str, category: str) -> DataFrame:
    """How many recommendations of each query share its category."""
    hit = F.col(category) == F.col(f"query_{category}")
    return recommended.groupBy(f"query_{row_id}", f"query_{category}").agg(
        F.count(F.lit(1)).alias("n_neighbours"), F.count_if(hit).alias("n_hits")
    )


def hit_rate(recommended: DataFrame, category: str) -> DataFrame:
    """Share of queries whose nearest neighbour has their category, per category."""
    hit = (F.col(category) == F.col(f"query_{category}")).cast("double")
    first = recommended.where(F.col("rank") == 1)
    return first.groupBy(F.col(f"query_{category}").alias(category)).agg(
        F.count(F.lit(1)).alias("n_queries"), F.coalesce(F.avg(hit), F.lit(0.0)).alias("hit_rate")
    )


def recommend_by_terms(
    docs: DataFrame, row_id: str, text: str, category: str, k: int = 10, seed: int = 42
) -> DataFrame:
    """For one random query per category of the data, its ``k - 1`` nearest documents by TF-IDF.

    Queries stay rows: their terms join the term table, and one aggregation per document and
    query sums the products of weights. Documents that share no term with a query score 0.
    """
    queries = cut(random_row_per_group(docs, row_id, category, seed)).select(
        F.col(category).alias("query_category"), F.col(row_id).alias("query_id")
    )
    weights = cut(tfidf_l2(docs, row_id, text))
    asked = weights.withColumnsRenamed({row_id: "query_id", "weight": "query_weight"})
    terms = cut(skew_join(asked, queries, "query_id").select("query_category", "query_id", "term", "query_weight"))
    sums = (
        skew_join(weights, terms, "term")
        .groupBy(row_id, "query_category", "query_id")
        .agg(F.sum(F.col("weight") * F.col("query_weight")).alias("sim"))
    )
    # Documents without a shared term rank last, by id. Of these at most k are ever needed,
    # and the 2k smallest ids hold enough rows that can fill a list of k - 1.
    first_ids = docs.select(row_id).orderBy(row_id).limit(2 * k).agg(F.collect_list(row_id)).scalar()
    zeros = queries.select(F.explode(first_ids).alias(row_id), "query_category", "query_id", F.lit(0.0).alias("sim"))
    scored = (
        sums.unionByName(zeros)
        .withColumn("sim", F.round("sim", DIGITS) + F.lit(0.0))
        .where(F.col(row_id) != F.col("query_id"))
    )
    # A document listed twice is its own row and its zero row; only the better one may stay.
    best = top_per_group(scored, ["query_category", "query_id"], [F.desc("sim"), F.asc(row_id)], 3 * k, "_place")
    unique = best.groupBy("query_category", "query_id", row_id).agg(F.max("sim").alias("sim"))
    return top_per_group(unique, ["query_category", "query_id"], [F.desc("sim"), F.asc(row_id)], k - 1)
