"""Profiling: counts, distinct counts, value counts, shares and curves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.operators.ranking import global_rank
from talkatlas.session import cut


def column_profile(df: DataFrame, columns: list[str], long_text: tuple[str, ...] = ()) -> DataFrame:
    """One row per column: type, rows, NULLs, empty strings, distinct values.

    One pass over the table. Distinct values of ``long_text`` columns are counted
    on their SHA-256 digest, so whole texts are never shuffled.
    """
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        value = F.sha2(F.col(c).cast("string"), 256) if c in long_text else F.col(c)
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_null"),
            F.count_if(F.col(c).cast("string") == "").alias(f"{c}_empty"),
            F.count_distinct(value).alias(f"{c}_distinct"),
        ]
    totals = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("data_type"),
            F.col("n_rows"),
            F.col(f"{c}_null").alias("n_null"),
            F.col(f"{c}_empty").alias("n_empty"),
            F.col(f"{c}_distinct").alias("n_distinct"),
        )
        for c in columns
    ]
    return totals.select(F.inline(F.array(*rows)))


def row_loss(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts of two tables and their difference."""
    counted = after.agg(F.count(F.lit(1))).scalar()
    return before.agg(F.count(F.lit(1)).alias("rows_before")).select(
        "rows_before",
        counted.alias("rows_after"),
        (F.col("rows_before") - counted).alias("rows_lost"),
    )


def distinct_count_per_group(df: DataFrame, group: str, item: str, out: str = "title_count") -> DataFrame:
    """Distinct ``item`` values per ``group``; both steps combine before they shuffle."""
    pairs = df.select(group, item).distinct()
    return pairs.groupBy(group).agg(F.count(F.lit(1)).alias(out))


def value_counts(df: DataFrame, column: str, out: str = "n_rows") -> DataFrame:
    """Rows per non-NULL value."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(out))


def top_share(counts: DataFrame, name: str, n: str, k: int = 5, rest: str = "others") -> DataFrame:
    """The ``k`` largest groups and one row for the rest, with their share in percent."""
    top = counts.orderBy(F.desc(n), F.asc_nulls_first(name)).limit(k).select(name, n)
    top_total = F.coalesce(top.agg(F.sum(n)).scalar(), F.lit(0))
    others = counts.agg((F.coalesce(F.sum(n), F.lit(0)) - top_total).cast("bigint").alias(n))
    total = counts.agg(F.sum(n)).scalar()
    return (
        top.unionByName(others.select(F.lit(rest).alias(name), n))
        .withColumn("percentage", F.when(total > 0, F.col(n) * 100.0 / total))
    )


def number_stats(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.agg(
        F.count(column).alias("n_rows"),
        F.avg(value).alias("mean"),
        F.max(column).alias("max"),
        F.min(column).alias("min"),
        F.stddev_samp(value).alias("std"),
    )


def rank_curve(df: DataFrame, row_id: str, value: str) -> DataFrame:
    """Values from largest to smallest with their position, ties by id."""
    narrow = cut(df.select(row_id, value))  # the sort reads its input twice
    return global_rank(narrow, [F.desc(value), F.asc(row_id)], "rank")
