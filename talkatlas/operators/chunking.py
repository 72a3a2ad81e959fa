"""Balanced token chunks of long texts.

Rows are multiplied with the outer forms of explode: the inner forms make the
optimizer add a not-empty filter that evaluates the exploded expression again.

Everything happens inside the row that holds the text, so chunking never
shuffles. A text of ``n`` tokens gets ``ceil(n / max_length)`` chunks whose sizes
differ by at most one, the larger ones first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.functions import text as T

MAX_LENGTH = 500


def div(a: Column, b: Column) -> Column:
    """Integer division of non-negative numbers."""
    return F.call_function("div", a, b)


def chunk_count(n: Column, max_length: int = MAX_LENGTH) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), div(n + (max_length - 1), F.lit(max_length)))


def chunk_budget(chunks: Column, max_length: int = MAX_LENGTH) -> Column:
    """Summary length allowed per chunk; never below one token."""
    return F.greatest(F.lit(1).cast("bigint"), div(F.lit(max_length), chunks))


def chunk_start(n: Column, chunks: Column, ix: Column) -> Column:
    return ix * div(n, chunks) + F.least(ix, n % chunks)


def chunk_length(n: Column, chunks: Column, ix: Column) -> Column:
    return div(n, chunks) + F.when(ix < n % chunks, 1).otherwise(0)


def chunk_of(n: Column, chunks: Column, position: Column) -> Column:
    """Chunk that holds the token at ``position`` (from 0)."""
    base, longer = div(n, chunks), n % chunks
    border = longer * (base + 1)
    return F.when(position < border, div(position, base + 1)).otherwise(
        longer + div(position - border, F.greatest(F.lit(1).cast("bigint"), base))
    )


def tokenised(docs: DataFrame, row_id: str, text: str, max_length: int = MAX_LENGTH, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(row_id, carry..., tokens, n_tokens, n_chunks, budget)``; a missing text has no tokens."""
    tokens = F.coalesce(T.tokens(F.col(text)), F.array().cast("array<string>"))
    return (
        docs.select(row_id, *carry, tokens.alias("tokens"))
        .withColumn("n_tokens", F.size("tokens").cast("bigint"))
        .withColumn("n_chunks", chunk_count(F.col("n_tokens"), max_length))
        .withColumn("budget", chunk_budget(F.col("n_chunks"), max_length))
    )


def _chunk_numbers() -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.col("n_chunks") - 1)


def chunk_plan(docs: DataFrame, row_id: str, n_tokens: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """One row per chunk: where it starts, how long it is and its summary budget."""
    n, chunks, ix = F.col("n_tokens"), F.col("n_chunks"), F.col("chunk_ix")
    return (
        docs.select(row_id, F.col(n_tokens).cast("bigint").alias("n_tokens"))
        .withColumn("n_chunks", chunk_count(n, max_length))
        .withColumn("chunk_ix", F.explode_outer(_chunk_numbers()))
        .select(
            row_id,
            "chunk_ix",
            chunk_start(n, chunks, ix).alias("chunk_start"),
            chunk_length(n, chunks, ix).cast("bigint").alias("chunk_length"),
            chunk_budget(chunks, max_length).alias("budget"),
        )
    )


def chunk_text(docs: DataFrame, row_id: str, text: str, max_length: int = MAX_LENGTH) -> DataFrame:
    """``(row_id, chunk_ix, chunk_text)``.

    The chunk texts are built before the rows are multiplied, so the token list
    of a long text is not copied once per chunk.
    """
    n, chunks = F.col("n_tokens"), F.col("n_chunks")

    def joined(ix: Column) -> Column:
        start, length = chunk_start(n, chunks, ix), chunk_length(n, chunks, ix)
        return F.array_join(F.slice("tokens", (start + 1).cast("int"), length.cast("int")), " ")

    texts = tokenised(docs, row_id, text, max_length).select(
        row_id, F.transform(_chunk_numbers(), joined).alias("texts")
    )
    exploded = texts.select(row_id, F.posexplode_outer("texts").alias("chunk_ix", "chunk_text"))
    return exploded.withColumn("chunk_ix", F.col("chunk_ix").cast("bigint"))


def concat_chunks(chunks: DataFrame, row_id: str, chunk_ix: str, text: str, out: str, sep: str = " ") -> DataFrame:
    """Join a row's chunk texts in chunk order. A row's chunks are bounded by its one text."""
    ordered = F.array_sort(F.collect_list(F.struct(chunk_ix, text)))
    return chunks.groupBy(row_id).agg(F.array_join(F.transform(ordered, lambda c: c[text]), sep).alias(out))
