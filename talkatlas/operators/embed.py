"""Text embeddings and pooling of token vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.functions import text as TX
from talkatlas.operators.skipgram import SHARD_BYTES, mean_vectors

HASHED_CELLS = 1 << 22  # values of one batch of embeddings


def embed_batch(
    df: DataFrame, text: str, make_predict_fn: Callable, dim: int, out: str = "embedding", batch_size: int = 64
) -> DataFrame:
    """Add an embedding column from a caller's model.

    ``make_predict_fn`` loads the model once per Python worker and returns a
    function from a batch of texts to an array of ``(batch, dim)`` floats.
    """
    model = predict_batch_udf(make_predict_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
    embedded = df.withColumn(out, model(text))
    right_size = F.when(F.size(out) == dim, F.col(out)).otherwise(
        F.raise_error(F.lit(f"the model must return {dim} values per text")).cast("array<float>")
    )
    return embedded.withColumn(out, right_size)


def embed_word2vec(
    docs: DataFrame,
    row_id: str,
    text: str,
    dim: int = 768,
    seed: int = 42,
    min_count: int = 5,
    partitions: int | None = None,
    max_iter: int = 1,
) -> DataFrame:
    """``(row_id, embedding)``: mean of word vectors trained on the same table.

    Training is spread over ``partitions`` shards (default: the shuffle partitions), or more where one would hold over
    ``skipgram.SHARD_BYTES`` of text. Words that occur fewer than ``min_count`` times count as zero vectors, a NULL text is one.
    """
    spark = docs.sparkSession
    held = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    shards = max(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARD_BYTES))
    return mean_vectors(
        docs, row_id, TX.tokens(F.col(text)), dim=dim, seed=seed, min_count=min_count, partitions=shards, max_iter=max_iter
    )


def _hashed(dim: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """id, tokens -> id, signed counts per hashed place at unit length. Each different token of a batch is hashed once."""
        for batch in batches:
            tokens = batch.column(1)
            counts = tokens.value_lengths().fill_null(0).to_numpy()
            coded = tokens.flatten().dictionary_encode()
            digests = [hashlib.md5(t.encode()).digest() for t in coded.dictionary.to_pylist()]
            heads = np.frombuffer(b"".join(digests), ">u4").reshape(len(digests), 4).astype(np.int64)
            place, sign = heads[:, 0] % dim, 1 - 2 * (heads[:, 1] % 2)
            code = coded.indices.to_numpy()
            step = max(1, HASHED_CELLS // dim)
            first = np.concatenate([[0], np.cumsum(counts)])
            for at in range(0, batch.num_rows, step):
                stop = min(batch.num_rows, at + step)
                part = code[first[at] : first[stop]]
                owner = np.repeat(np.arange(stop - at), counts[at:stop])
                sums = np.bincount(owner * dim + place[part], sign[part], minlength=(stop - at) * dim).astype(float).reshape(-1, dim)
                length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
                unit = np.divide(sums, length, out=np.zeros_like(sums), where=length > 0)
                offsets = np.arange(stop - at + 1, dtype=np.int32) * dim
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, stop - at), pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit.ravel()))],
                    [batch.schema.names[0], "embedding"],
                )

    return task


def embed_hashed(docs: DataFrame, row_id: str, text: str, dim: int = 768) -> DataFrame:
    """``(row_id, embedding)``: every word of a text counts, at a place and with a sign that its digest gives, at unit length.

    There is no vocabulary and nothing to train: a word that occurs once in the corpus moves its text's vector, and texts
    can be embedded one by one. Two different words agree in place and sign once in ``2 * dim`` pairs. A NULL
    text, or one without words, is the zero vector.
    """
    tokenised = docs.select(row_id, TX.tokens(F.col(text)).alias("_tokens"))
    kind = docs.schema[row_id].dataType.simpleString()
    return tokenised.mapInArrow(_hashed(dim), f"`{row_id}` {kind}, embedding array<double>")


def pool_mean(token_vectors: DataFrame, row_id: str, vector: str, out: str = "embedding") -> DataFrame:
    """Mean of a row's token vectors; partial sums are merged before the shuffle."""
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    return token_vectors.groupBy(row_id).agg(vector_to_array(Summarizer.mean(as_vector)).alias(out))


def pool_last(token_vectors: DataFrame, row_id: str, position: str, vector: str, out: str = "embedding") -> DataFrame:
    """Vector of a row's last real token."""
    return token_vectors.groupBy(row_id).agg(F.max_by(vector, position).alias(out))
