"""Vector stores and vectors kept as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.functions import vector as V


def last_per_title(vectors: DataFrame, title: str, vector: str, position: str) -> DataFrame:
    """One vector per title; the last row wins."""
    return vectors.groupBy(title).agg(F.max_by(vector, position).alias(vector))


def write_store(vectors: DataFrame, path: str, title: str, vector: str, position: str) -> None:
    last_per_title(vectors, title, vector, position).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_vectors(df: DataFrame, text: str, dim: int, out: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows whose text holds ``dim`` finite numbers, and the rows that do not."""
    parsed = df.withColumn(out, V.text_to_vector(F.col(text)))
    good = V.is_vector(F.col(out), dim)
    return parsed.where(good), parsed.where(~good)
