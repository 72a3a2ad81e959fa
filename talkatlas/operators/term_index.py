"""Search by TF-IDF through a stored term index: exact, reading few of the postings.

A query's terms are ordered by squared weight per posting, rare and heavy ones first. Vectors have unit length, so a
document that shares only the last terms of that order scores at most the norm of the query's weights of these terms.
Once that norm is below the k-th best score known, documents reached by the first terms are the only candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from talkatlas.operators.knn import DIGITS
from talkatlas.operators.ranking import top_per_group
from talkatlas.operators.skew import skew_join
from talkatlas.operators.tfidf import document_frequency, tfidf_l2
from talkatlas.session import stored

SLACK = 2 * 10.0**-DIGITS  # scores are compared after rounding, so bounds give way by more than a rounding step
FIRST_MASS = 0.3  # share of a query's squared length whose postings give the first k documents


@dataclass(frozen=True)
class TermIndex:
    """``rows``: one per document, its terms and weights; ``postings``: one per document and term, in segments in the order
    of terms; ``terms``: how many documents hold a term; ``ids``: all documents, those without a term as well."""

    rows: DataFrame
    postings: DataFrame
    terms: DataFrame
    ids: DataFrame
    row_id: str


def build_term_index(docs: DataFrame, path: str, row_id: str, text: str) -> None:
    """Write the index of ``docs`` below ``path``.

    Rows with a NULL id take no part; texts of one id count as one document. Postings are written in segments, one per file
    of rows and in the order of ``(term, row_id)``, so they are not shuffled and a term that most documents hold is spread over many files.
    """
    spark = docs.sparkSession
    known = docs.where(F.col(row_id).isNotNull())
    known.select(row_id).distinct().write.parquet(f"{path}/ids")
    entry = F.struct("term", "weight")
    tfidf_l2(known, row_id, text).groupBy(row_id).agg(F.collect_list(entry).alias("entries")).write.parquet(f"{path}/rows")
    postings = spark.read.parquet(f"{path}/rows").select(row_id, F.inline("entries"))
    postings.sortWithinPartitions("term", row_id).write.parquet(f"{path}/postings")
    document_frequency(spark.read.parquet(f"{path}/postings")).write.parquet(f"{path}/terms")


def open_term_index(spark: SparkSession, path: str, row_id: str) -> TermIndex:
    rows, postings, terms, ids = (spark.read.parquet(f"{path}/{part}") for part in ("rows", "postings", "terms", "ids"))
    return TermIndex(rows, postings, terms, ids, row_id)


def _asked_terms(index: TermIndex, queries: DataFrame) -> DataFrame:
    """``(query_id, term, asked, df, rest)``; ``rest`` is the norm of the query's weights from this term on."""
    own = skew_join(index.rows.withColumnRenamed(index.row_id, "query_id"), queries, "query_id")
    asked = own.select("query_id", F.inline("entries")).withColumnRenamed("weight", "asked")
    mass = F.col("asked") * F.col("asked")
    from_here = Window.partitionBy("query_id").orderBy(F.desc(mass / F.col("df")), "term")
    rest = F.sqrt(F.sum(mass).over(from_here.rowsBetween(0, Window.unboundedFollowing)))
    return stored(skew_join(index.terms, asked, "term").withColumn("rest", rest), "asked-terms")


def _reached(index: TermIndex, asked: DataFrame) -> DataFrame:
    """Every other document that holds one of the terms: its score by them, and the squared length they have in it."""
    met = skew_join(index.postings, asked.select("query_id", "term", "asked"), "term")
    pairs = met.where(F.col(index.row_id) != F.col("query_id")).groupBy("query_id", index.row_id)
    return pairs.agg(
        F.sum(F.col("weight") * F.col("asked")).alias("partial"), F.sum(F.col("weight") * F.col("weight")).alias("seen")
    )


def _scored(index: TermIndex, pairs: DataFrame, asked: DataFrame) -> DataFrame:
    """``(query_id, row_id, sim)`` of given pairs by all their terms."""
    entries = skew_join(index.rows, pairs.select("query_id", index.row_id), index.row_id)
    terms = entries.select("query_id", index.row_id, F.inline("entries"))
    shared = skew_join(terms, asked.select("query_id", "term", "asked"), ["query_id", "term"])
    sim = F.sum(F.col("weight") * F.col("asked"))
    return shared.groupBy("query_id", index.row_id).agg(sim.alias("sim"))


def _best(scored: DataFrame, by: str, row_id: str, k: int) -> DataFrame:
    return top_per_group(scored, ["query_id"], [F.desc(by), F.asc(row_id)], k)


def _rounded(sim: Column) -> Column:
    return F.round(sim, DIGITS) + F.lit(0.0)


def search(index: TermIndex, queries: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The ``k`` documents nearest to each indexed document in ``queries`` (column ``query_id``), and the effort.

    The rows are those of a comparison with every document: ``(query_id, row_id, sim, rank)``, ties by id, the query left
    out, documents without a shared term at 0. The effort has ``query_id``, ``n_postings`` of the query's terms, how many
    of them were read (``n_read``; the postings of the first look count twice when they are read again) and
    ``n_candidates`` scored in full. Ids that are NULL or not in the index give no rows, repeated ones give them once.

    1. The first ``FIRST_MASS`` of a query's squared length finds ``k`` documents. Their full scores give the bound.
    2. Postings are read up to the term from which the rest of the query cannot reach the bound.
    3. What a document lacks is at most the rest of the query times the rest of the document; documents that stay
       below the bound even so go, the others are scored by all their terms.

    With fewer than ``k`` documents in the first look there is no bound, and all terms are read.
    """
    row_id = index.row_id
    ids = queries.select("query_id").distinct()
    known = stored(skew_join(index.ids.withColumnRenamed(row_id, "query_id"), ids, "query_id"), "queries")
    asked = _asked_terms(index, known)
    length = F.max("rest").over(Window.partitionBy("query_id"))
    first = asked.withColumn("length", length).where(F.col("rest") ** 2 > (1 - FIRST_MASS) * F.col("length") ** 2)
    seeds = stored(_best(_reached(index, first), "partial", row_id, k), "first-documents")
    bounds = _scored(index, seeds, asked).groupBy("query_id").agg(F.min("sim").alias("bound"), F.count("sim").alias("n"))
    bound = F.when(F.col("n") >= k, F.col("bound") - SLACK)
    bounds = stored(bounds.select("query_id", bound.alias("bound")).where(F.col("bound") > 0), "bounds")
    judged = asked.join(bounds, "query_id", "left")
    needed = F.coalesce(F.col("rest") >= F.col("bound"), F.lit(True))
    judged = stored(judged.withColumn("needed", needed), "judged-terms")
    unread = F.coalesce(F.max(F.when(~F.col("needed"), F.col("rest"))), F.lit(0.0))
    limits = judged.groupBy("query_id").agg(F.max("bound").alias("bound"), unread.alias("unread"))
    reached = skew_join(_reached(index, judged.where("needed")), limits, "query_id")
    lacking = F.col("unread") * F.sqrt(F.greatest(F.lit(0.0), 1 - F.col("seen")))
    hopeful = F.coalesce(F.col("partial") + lacking >= F.col("bound"), F.lit(True))
    candidates = stored(reached.where(hopeful).select("query_id", row_id), "candidates")
    scored = _scored(index, candidates, asked).withColumn("sim", _rounded(F.col("sim")))
    found = stored(_best(scored, "sim", row_id, k), "found").drop("rank")
    effort = (
        judged.groupBy("query_id")
        .agg(F.sum("df").alias("n_postings"), F.coalesce(F.sum(F.when(F.col("needed"), F.col("df"))), F.lit(0)).alias("n_needed"))
        .join(first.groupBy("query_id").agg(F.sum("df").alias("n_first")), "query_id", "left")
        .join(candidates.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_candidates")), "query_id", "left")
        .select(
            "query_id", "n_postings", (F.col("n_needed") + F.coalesce("n_first", F.lit(0))).alias("n_read"),
            F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"),
        )
    )
    return _filled(index, known, found, k), effort


def _filled(index: TermIndex, queries: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Lists shorter than ``k`` go on with the documents of no shared term, by id.

    Among the ``2 * k + 1`` smallest ids at least ``k`` are neither the query nor in its list.
    """
    row_id = index.row_id
    first_ids = index.ids.orderBy(row_id).limit(2 * k + 1).agg(F.collect_list(row_id)).scalar()
    zeros = queries.select("query_id", F.explode(first_ids).alias(row_id), F.lit(0.0).alias("sim"))
    lists = found.unionByName(zeros.where(F.col(row_id) != F.col("query_id")))
    return _best(lists.groupBy("query_id", row_id).agg(F.max("sim").alias("sim")), "sim", row_id, k)
