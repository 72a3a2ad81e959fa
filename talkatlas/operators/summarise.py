"""Summaries of long texts: extractive on Spark, or by a caller's model per chunk."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.operators.chunking import (
    MAX_LENGTH,
    chunk_budget,
    chunk_length,
    chunk_of,
    chunk_start,
    chunk_text,
    concat_chunks,
    div,
    tokenised,
)
from talkatlas.operators.split import sample_rows
from talkatlas.operators.tfidf import doc_count, document_frequency, idf_smooth, term_counts, with_document_frequency
from talkatlas.session import cut, dealt

SPAN = 20


def span_scores(
    docs: DataFrame, row_id: str, text: str, max_length: int = MAX_LENGTH, span: int = SPAN,
    corpus: DataFrame | None = None,
) -> DataFrame:
    """``(row_id, n_chunks, chunk_ix, span_ix, score)``: TF-IDF weight of a span's distinct terms.

    Document frequencies are those of ``corpus`` (default: ``docs``).

    The places of a term travel with its count, so the weights need no join back
    to the tokens. A document's rows all come from its one text. The document's
    vector length is summed next to the span weights, each term adding its square
    at its first place only, so it takes a window over spans and not over terms.
    """
    n, chunks = F.col("n_tokens"), F.col("n_chunks")
    per_chunk = math.ceil(max_length / span)
    chunk = chunk_of(n, chunks, F.col("position").cast("bigint"))
    place = F.col("chunk_ix") * per_chunk + div(
        F.col("position") - chunk_start(n, chunks, F.col("chunk_ix")), F.lit(span)
    )
    counts = cut(
        tokenised(dealt(docs.select(row_id, text), row_id, text), row_id, text, max_length)
        .select(row_id, "n_tokens", "n_chunks", F.posexplode_outer("tokens").alias("position", "term"))
        .where(F.col("term").isNotNull())
        .withColumn("chunk_ix", chunk)
        .groupBy(row_id, "n_chunks", "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.collect_set(place).alias("places"))
    )
    is_term = F.char_length("term") >= 2
    freq = None if corpus is None else cut(document_frequency(term_counts(corpus, row_id, text)))
    weighted = with_document_frequency(counts.where(is_term), freq).withColumn(
        "weight", F.col("tf") * idf_smooth(doc_count(docs if corpus is None else corpus))
    )
    others = counts.where(~is_term).withColumn("weight", F.lit(0.0))
    columns = [row_id, "n_chunks", "places", "weight"]
    squared_once = F.when(F.col("nth") == 0, F.col("weight") * F.col("weight")).otherwise(0.0)
    sums = (
        weighted.select(*columns)
        .unionByName(others.select(*columns))
        .select(row_id, "n_chunks", "weight", F.posexplode_outer("places").alias("nth", "place"))
        .groupBy(row_id, "n_chunks", "place")
        .agg(F.sum("weight").alias("total"), F.sum(squared_once).alias("squares"))
    )
    size = F.sqrt(F.sum("squares").over(Window.partitionBy(row_id)))
    return sums.select(
        row_id,
        "n_chunks",
        div(F.col("place"), F.lit(per_chunk)).alias("chunk_ix"),
        (F.col("place") % per_chunk).alias("span_ix"),
        F.when(size == 0, F.lit(0.0)).otherwise(F.col("total") / size).alias("score"),
    )


def summarise(
    docs: DataFrame, row_id: str, text: str, max_length: int = MAX_LENGTH, span: int = SPAN,
    corpus: DataFrame | None = None,
) -> DataFrame:
    """``(row_id, summary)``: the best spans of every chunk, in their order.

    Each chunk keeps ``budget div span`` spans, at least one, and no more than
    ``budget`` tokens.
    """
    budget = chunk_budget(F.col("n_chunks"), max_length)
    keep = F.greatest(F.lit(1).cast("bigint"), div(budget, F.lit(span)))
    best_first = Window.partitionBy(row_id, "chunk_ix").orderBy(F.round("score", 6).desc(), F.asc("span_ix"))
    chosen = (
        span_scores(docs, row_id, text, max_length, span, corpus)
        .withColumn("_rank", F.row_number().over(best_first))
        .where(F.col("_rank") <= keep)
        .groupBy(row_id)
        .agg(F.array_sort(F.collect_list(F.struct("chunk_ix", "span_ix"))).alias("places"))
    )
    n, chunks = F.col("n_tokens"), F.col("n_chunks")

    def piece(place: Column) -> Column:
        ix, offset = place["chunk_ix"], place["span_ix"] * span
        start = chunk_start(n, chunks, ix) + offset
        length = F.least(F.lit(span).cast("bigint"), chunk_length(n, chunks, ix) - offset, F.col("budget"))
        return F.slice("tokens", (start + 1).cast("int"), length.cast("int"))

    spans = F.flatten(F.transform("places", piece))
    # Texts and not their tokens meet the places, which are fewer bytes to move.
    placed = docs.select(row_id, text).join(chosen, row_id, "left")
    return (
        tokenised(placed, row_id, text, max_length, ("places",))
        .select(row_id, F.coalesce(F.array_join(spans, " "), F.lit("")).alias("summary"))
    )


def summarise_sample(docs: DataFrame, row_id: str, text: str, k: int, seed: int = 42) -> DataFrame:
    """Summaries of ``k`` random rows; term weights come from the whole table."""
    return summarise(cut(sample_rows(docs.select(row_id, text), row_id, k, seed)), row_id, text, corpus=docs)


def summarise_with_model(
    docs: DataFrame,
    row_id: str,
    text: str,
    make_predict_fn: Callable,
    max_length: int = MAX_LENGTH,
    batch_size: int = 64,
    sep: str = " ",
) -> DataFrame:
    """Summaries by a caller's text-to-text model, batched over the chunks of all documents."""
    model = predict_batch_udf(make_predict_fn, return_type=T.StringType(), batch_size=batch_size)
    chunks = chunk_text(docs, row_id, text, max_length)
    return concat_chunks(chunks.withColumn("_s", model("chunk_text")), row_id, "chunk_ix", "_s", "summary", sep)


def cost_table(docs: DataFrame, row_id: str, text: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """What summarising each row will cost: tokens, chunks and summary budget."""
    return tokenised(docs, row_id, text, max_length).drop("tokens")


