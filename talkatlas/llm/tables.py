"""Tables kept between steps in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkatlas.session import scratch_path


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and go on from the written copy.

    A lost executor costs no recomputation past this point, and both sides of a later
    join start from files, so Spark may split a skewed partition of either.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
