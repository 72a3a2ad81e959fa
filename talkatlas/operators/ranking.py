"""Row positions over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkatlas.session import cut


def global_rank(df: DataFrame, order_by: list[Column], out: str = "rank", start: int = 0) -> DataFrame:
    """Add the row's position in the total order ``order_by`` (which must have no ties).

    A range-partitioned sort splits even a value that fills a third of the rows,
    because the tie-breaking id is part of the order. The sorted rows are written
    once, so a rerun task cannot move them; the only thing broadcast is one
    offset per sort partition.
    """
    rows = cut(
        df.orderBy(*order_by).withColumns(
            {"_part": F.spark_partition_id(), "_seq": F.monotonically_increasing_id()}
        )
    )
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    position = (F.col("_offset") + F.col("_seq") - F.col("_first") + start).cast("bigint")
    return rows.join(F.broadcast(offsets), "_part").select(*df.columns, position.alias(out))


def top_per_group(df: DataFrame, group: list[str], order_by: list[Column], k: int, out: str = "rank") -> DataFrame:
    """First ``k`` rows of each group. Spark trims each partition to ``k`` before it shuffles."""
    order = Window.partitionBy(*group).orderBy(*order_by)
    return df.withColumn(out, F.row_number().over(order).cast("bigint")).where(F.col(out) <= k)
