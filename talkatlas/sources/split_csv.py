"""One large quoted CSV file read by many tasks, whatever line breaks its values hold.

A physical line ends a record if the quotes of its file up to there are even in number; a doubled quote inside a value
counts twice and changes nothing. So a first pass counts the quotes of each split, sums over the splits of a file tell how
each one begins, and a second pass joins the lines of a record. Records inside one split move nowhere; only
the pieces at the edges of splits, two at most each, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.operators.skew import LOOKUP_BYTES, measured_bytes
from talkatlas.session import stored
from talkatlas.sources.files import REJECTED, TRANSCRIPT_SCHEMA

_KEY = ["file", "split"]
_PIECES = "file string, split long, no long, head boolean, closed boolean, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split")]
    return text.select(*place, "value", (quotes % 2).cast("long").alias("odd"), F.monotonically_increasing_id().alias("seq"))


def _split_starts(lines: DataFrame) -> DataFrame:
    """``(file, split, inside)``: 1 where a split begins inside a quoted value. One row per split."""
    odd = stored(lines.groupBy(*_KEY).agg((F.sum("odd") % 2).alias("odd")), "csv-splits")
    broken = odd.groupBy("file").agg(F.sum("odd").alias("n")).where(F.col("n") % 2 == 1).orderBy("file").limit(3).collect()
    if broken:
        raise ValueError(f"quotes are never closed in {', '.join(r.file for r in broken)}")
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return stored(odd.select(*_KEY, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside")), "csv-starts")


def _with_start(lines: DataFrame, starts: DataFrame) -> DataFrame:
    """Lines with the ``inside`` of their split, those of one split in order in one task."""
    if measured_bytes(starts) <= LOOKUP_BYTES:
        joined = lines.join(F.broadcast(starts), _KEY, "left")
    else:
        joined = lines.join(starts.hint("merge"), _KEY, "left").repartition(*_KEY).sortWithinPartitions(*_KEY, "seq")
    known = F.coalesce("inside", F.raise_error(F.lit("the file was split differently in the second pass")).cast("long"))
    return joined.select(*_KEY, "value", "odd", known.alias("inside"))


def _joined_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Records and pieces of records; what is held at any time is one batch and one record."""
    place, held, inside, no, head = None, [], 0, 0, False
    for batch in batches:
        out: list[tuple] = []
        new = (batch["file"] != batch["file"].shift()) | (batch["split"] != batch["split"].shift())
        edges = [*np.flatnonzero(new.to_numpy()), len(batch)]
        for start, stop in zip(edges[:-1], edges[1:]):
            here = (batch["file"].iat[start], int(batch["split"].iat[start]))
            if here != place:
                if held:
                    out.append((*place, no, head, False, "\n".join(held)))
                place, held, inside, no = here, [], int(batch["inside"].iat[start]), 0
                head = inside == 1
            values = batch["value"].iloc[start:stop].tolist()
            parity = (inside + np.cumsum(batch["odd"].to_numpy()[start:stop])) % 2
            inside = int(parity[-1])
            done = 0
            for end in np.flatnonzero(parity == 0):
                out.append((*place, no, head, True, "\n".join([*held, *values[done : end + 1]])))
                held, done, no, head = [], end + 1, no + 1, False
            held += values[done:]
        if out:
            yield pd.DataFrame(out, columns=["file", "split", "no", "head", "closed", "record"])
    if held:
        last = (*place, no, head, False, "\n".join(held))
        yield pd.DataFrame([last], columns=["file", "split", "no", "head", "closed", "record"])


def _records(pieces: DataFrame) -> DataFrame:
    """``(split, no, record)`` of whole records; pieces go to the split in which their record begins."""
    whole = ~F.col("head") & F.col("closed")
    loose = pieces.where(~whole)
    so_far = Window.partitionBy("file").orderBy("split", "no").rowsBetween(Window.unboundedPreceding, 0)
    first = F.last(F.when(~F.col("head"), F.struct("split", "no")), ignorenulls=True).over(so_far)
    owners = loose.select(*_KEY, "no", "head").select(*_KEY, "no", first.alias("first"))
    parts = F.sort_array(F.collect_list(F.struct("split", "no", "record")))
    mended = (
        loose.join(owners, [*_KEY, "no"])
        .groupBy("file", "first")
        .agg(F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    )
    return pieces.where(whole).select("split", "no", "record").unionByName(mended.select("first.split", "first.no", "record"))


def read_csv_split(
    spark: SparkSession, path: str, schema: T.StructType = TRANSCRIPT_SCHEMA, audit: bool = False
) -> DataFrame:
    """The rows of :func:`talkatlas.sources.files.read_csv`, each file read by as many tasks as it has splits.

    Files have a header each, values that hold quotes are quoted and their quotes doubled, and lines end in LF or CRLF; a
    quote inside an unquoted value is not allowed. Empty lines between records are skipped. A file whose quotes
    are never closed is refused. The records are written to the shared folder once, between the two passes and the parsing.
    """
    if audit:
        schema = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    lines = _lines(spark, path)
    pieces = stored(_with_start(lines, _split_starts(lines)).mapInPandas(_joined_lines, _PIECES), "csv-records")
    header = (F.col("split") == 0) & (F.col("no") == 0)
    records = _records(pieces).where(~header).select(F.regexp_replace("record", "\r$", "").alias("record"))
    options = {"quote": '"', "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": REJECTED}
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return records.where(F.col("record") != "").select(F.from_csv("record", kinds, options).alias("row")).select("row.*")
