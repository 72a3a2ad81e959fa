"""Distinct counts from stored sketches: a table that grows by parts is read once, and counts merge over its parts.

A sketch keeps at most about ``2**(bits + 1)`` 64-bit hashes, whatever the table holds. Up to ``2**bits`` different values its
count is exact but for colliding hashes; beyond, its standard error is ``1 / sqrt(2**bits)`` of the count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 12  # 4,096 values exactly, then a standard error of 1.6 %


def standard_error(bits: int = BITS) -> float:
    """Relative standard error of a count above ``2**bits``."""
    return 2.0 ** (-bits / 2)


def _value(column: Column) -> Column:
    """A hash of the value, so that empty strings and every type without maps count; NULL counts nowhere."""
    return F.when(column.isNotNull(), F.xxhash64(column))


def distinct_sketches(df: DataFrame, columns: list[str], group: tuple[str, ...] = (), bits: int = BITS) -> DataFrame:
    """``(*group, column_name, n_rows, n_null, n_empty, sketch)``: one row per group and column, from one pass over ``df``.

    Rows are combined before the shuffle, so a group that holds a third of them is one row per task. NULL is a group of
    its own. Without ``group`` an empty table gives rows with zero counts.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"_null_{i}"),
            F.count_if(F.col(c).cast("string") == "").alias(f"_empty_{i}"),
            F.theta_sketch_agg(_value(F.col(c)), bits).alias(f"_sketch_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("_rows").alias("n_rows"),
            F.col(f"_null_{i}").alias("n_null"),
            F.col(f"_empty_{i}").alias("n_empty"),
            F.col(f"_sketch_{i}").alias("sketch"),
        )
        for i, c in enumerate(columns)
    ]
    return df.groupBy(*group).agg(*aggs).select(*group, F.inline(F.array(*rows)))


def merge(sketches: DataFrame, by: tuple[str, ...] = (), bits: int = BITS) -> DataFrame:
    """Sketches of one column with equal ``by`` values as one; ``bits`` at most those they were made with."""
    sums = [F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_empty")]
    return sketches.groupBy(*by, "column_name").agg(*sums, F.theta_union_agg("sketch", bits).alias("sketch"))


def counted(sketches: DataFrame) -> DataFrame:
    """``n_distinct`` in place of the sketch."""
    return sketches.withColumn("n_distinct", F.theta_sketch_estimate("sketch").cast("bigint")).drop("sketch")


def store_sketches(sketches: DataFrame, path: str, part: str) -> None:
    """Write sketches below ``path``, in a folder for each value of ``part``.

    A part that is there already is replaced, so that a run repeated after a failure counts no row twice.
    """
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
