"""CSV and text-line sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSCRIPT_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("transcript", T.StringType()),
        T.StructField("playlist_name", T.StringType()),
    ]
)
INDEX_COLUMN = "row_ix"
REJECTED = "_corrupt_record"


def with_index(schema: T.StructType) -> T.StructType:
    """``schema`` behind a stored index column."""
    return T.StructType([T.StructField(INDEX_COLUMN, T.LongType()), *schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TRANSCRIPT_SCHEMA, audit: bool = False) -> DataFrame:
    """CSV with a header whose quoted values may hold line breaks.

    Missing values stay NULL. With ``audit`` a row that does not fit the schema
    keeps its raw text in ``_corrupt_record``. A multi-line file is read by one
    task, so large tables belong in many files; land them as Parquet once.
    """
    if audit:
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that :func:`read_csv` reads back, one file per partition; an empty string comes back as NULL."""
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string").alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_key)``; keys order the lines of the files as written.

    Number and name of the file, offset of the split and position inside it, so a
    large file may be read by many tasks, and 100,000 files and more keep their order.
    """
    name = F.col("_metadata.file_name")
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint").alias("part"),
            name.alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("line_key"),
    )
