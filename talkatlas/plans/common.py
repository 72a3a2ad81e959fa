"""Inputs shared by the registered queries, as DataFrames and as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.session import spread

DIM = 64  # width of the vectors in the embeddings table


@dataclass(frozen=True)
class Query:
    """A registered query; ``sql`` is its twin for another engine, where one exists."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents under the names of a transcript table; titles repeat."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws(" ", "lang", "n_chars").alias("title"),
        F.col("text").alias("transcript"),
        F.col("source").alias("playlist_name"),
        F.col("lang").alias("category"),
    )


def spread_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts ahead of work that is heavy per row."""
    return spread(transcripts(spark, sf_dir))


TRANSCRIPTS = """(
  SELECT doc_id, lang || ' ' || n_chars AS title, text AS transcript, source AS playlist_name, lang AS category
  FROM documents)"""


def partly_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts, NULL where the labels table marks the document as toxic."""
    marks = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    kept = F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 0, F.col("transcript"))
    return spread_transcripts(spark, sf_dir).join(marks, "doc_id", "left").withColumn("transcript", kept).drop("toxic")


PARTLY_MISSING = f"""(
  SELECT doc_id, title, CASE WHEN coalesce(toxic, 0) = 0 THEN transcript END AS transcript, playlist_name, category
  FROM {TRANSCRIPTS} LEFT JOIN labels USING (doc_id))"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings with their label as a bigint category."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").cast("bigint").alias("category"))


VECTORS = "(SELECT vec_id, embedding::DOUBLE[] AS embedding, label::BIGINT AS category FROM embeddings)"
