"""Corpus preparation: filter, clean, deduplicate and pack the documents.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``. All but the last return the
columns of documents: ``doc_id, text, lang, source, n_chars``, with ``n_chars`` the code points of the text that
is left. No stage looks at ``lang``; a NULL text stays NULL and is packed as an empty one.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.llm import boilerplate, packing, quality, simhash, suffixes
from talkatlas.llm.registry import WORD_BPE
from talkatlas.llm.tables import kept, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``labels`` of the rows in ``docs``."""
    return quality.accepted(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate across sources."""
    left = boilerplate.without_boilerplate(docs.select(*COLUMNS))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id."""
    return simhash.one_of_each(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words and more that an earlier document holds."""
    return suffixes.without_repeats(docs.select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and their place in it."""
    return packing.packed_documents(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("line dedup", clean_lines),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", pack),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
