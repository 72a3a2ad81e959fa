"""Dictionary lemmas and the full column preprocessing chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.functions import text as T
from talkatlas.operators.skew import skew_join
from talkatlas.session import dealt, stored


def lemmatise(
    docs: DataFrame, row_id: str, text: str, lemmas: DataFrame, stop_words: list[str], out: str = "lemmas"
) -> DataFrame:
    """``(row_id, out)``: words replaced by their lemma, stop words dropped, order kept.

    ``lemmas`` has one ``(token, lemma)`` row per token. Each distinct word of a
    row is looked up once, with all its positions; common words do not pile up, see
    :func:`skew_join`. Texts are written once and dealt to tasks of bounded bytes; with a broadcast lookup, the words
    never leave these tasks. A text without words stays as one row without a token.
    """
    texts = stored(docs.where(F.col(text).isNotNull()).select(row_id, text), "texts")
    listed = dealt(texts, row_id, text).select(row_id, F.posexplode_outer(T.words(F.col(text))).alias("position", "token"))
    places = listed.groupBy(row_id, "token").agg(F.collect_list("position").alias("positions"))
    looked_up = skew_join(places, lemmas, "token", "left")
    word = F.when(~F.col("token").isin(stop_words), F.coalesce("lemma", "token"))
    placed = F.transform("positions", lambda p: F.struct(p.alias("position"), F.col("word")))
    return (
        looked_up.select(row_id, "positions", word.alias("word"))
        .select(row_id, F.when(F.col("word").isNotNull(), placed).alias("placed"))
        .groupBy(row_id)
        .agg(F.array_sort(F.flatten(F.collect_list("placed"))).alias("placed"))
        .select(row_id, F.array_join(F.transform("placed", lambda p: p["word"]), " ").alias(out))
    )


def preprocess_column(
    df: DataFrame,
    row_id: str,
    column: str,
    lemmas: DataFrame | None = None,
    stop_words: list[str] | None = None,
    out: str = "processed_value",
) -> DataFrame:
    """Drop missing values, clean, lemmatise (with ``lemmas``), drop stop words, add ``out``."""
    kept = df.dropna(subset=[column])
    cleaned = kept.withColumn(out, T.clean_text(F.col(column)))
    if lemmas is not None:
        cleaned = kept.join(lemmatise(cleaned, row_id, out, lemmas, stop_words or [], out), row_id)
    if stop_words is not None:
        cleaned = cleaned.withColumn(out, T.remove_stop_words(F.col(out), stop_words))
    return cleaned
