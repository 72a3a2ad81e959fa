"""Exact TF-IDF in long form: one row per document and term."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkatlas.functions import text as T
from talkatlas.operators.skew import frequent_join
from talkatlas.session import cut, dealt

TERM = rf"{T.WORD}{{2,}}"


def term_counts(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, term, tf)``.

    Texts are dealt by id to tasks of bounded bytes first, so the count per document and term needs no
    further shuffle. The outer explode avoids the not-empty filter that would
    tokenise every text twice.
    """
    found = F.regexp_extract_all(F.lower(F.col(text)), F.lit(TERM), F.lit(0))
    terms = dealt(docs.select(row_id, text), row_id, text).select(row_id, F.explode_outer(found).alias("term"))
    return terms.where(F.col("term").isNotNull()).groupBy(row_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(counts: DataFrame) -> DataFrame:
    """``(term, df)``; partial counts are merged before the shuffle, so common terms do not pile up."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def with_document_frequency(counts: DataFrame, freq: DataFrame | None = None) -> DataFrame:
    """Attach ``df`` to every row of a written table (default: that of ``counts``); terms without one are left out."""
    return frequent_join(counts, document_frequency(counts) if freq is None else freq, "term", "df")


def idf_smooth(n_docs: Column) -> Column:
    return F.ln((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0


def idf_plain(n_docs: Column) -> Column:
    return F.ln((n_docs + 1.0) / (F.col("df") + 1.0))


def doc_count(docs: DataFrame) -> Column:
    return docs.agg(F.count(F.lit(1)).cast("double")).scalar()


def l2_normalise(weights: DataFrame, row_id: str, weight: str = "weight") -> DataFrame:
    size = F.sqrt(F.sum(F.col(weight) * F.col(weight)).over(Window.partitionBy(row_id)))
    return weights.withColumn(weight, F.when(size == 0, F.lit(0.0)).otherwise(F.col(weight) / size))


def tfidf_l2(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, term, weight)``: smoothed idf, unit length per document.

    Documents meet their terms again in as many tasks as they were dealt to, and are weighed there.
    """
    counts = cut(term_counts(docs, row_id, text))
    idf = idf_smooth(doc_count(docs))
    found = with_document_frequency(counts).repartition(max(1, counts.rdd.getNumPartitions()), row_id)
    return l2_normalise(found.select(row_id, "term", (F.col("tf") * idf).alias("weight")), row_id)


def tfidf_unsmoothed(docs: DataFrame, row_id: str, text: str) -> DataFrame:
    """``(row_id, term, tf, df, weight)``: ``tf * ln((n + 1) / (df + 1))``, not normalised."""
    counts = cut(term_counts(docs, row_id, text))
    idf = idf_plain(doc_count(docs))
    return with_document_frequency(counts).withColumn("weight", F.col("tf") * idf)
