"""Interaction of document filters: what every order of the filters removes at every step.

1. A document's *mask* has one bit per filter that it fails. Masks are found inside the row; only "identical to a
   document with a smaller id" needs the rest of the table: the least id of every text digest.
2. Documents are counted by part and mask, so at most ``2 ** 5`` rows a part leave the first aggregation, however
   large the part is.
3. Every mask maps to one big integer with a field of ``FIELD_BITS`` for each counter of each of the 600
   outcomes (120 orders of 5 steps). The integers of a part are summed, each times its number of documents, and the
   sums are unpacked into rows. A field cannot run over into the next: it holds any 64-bit count of documents.

Words are maximal runs of anything but ASCII white space. A NULL text is empty. A NULL source is the part ``""``. A row with a
NULL id is compared with no other (it cannot fail E) and has no labels; rows that repeat an id count one by one, and
their texts are not compared with each other. Of several labels of one id the largest counts. An empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.tables import kept

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = len(FILTERS)
OUTCOMES = len(ORDERS) * STEPS
COUNTERS = ("kept", "removed", "redundant", "unique_fails")
FIELD_BITS = 64
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = " \t\n\x0b\f\r"
SCHEMA = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long,"
    " good_lost long, toxic_lost long, shapley long"
)


def packed(mask: int) -> int:
    """The big integer of one document with this mask: a 1 in the field of every counter of every outcome that it adds to."""
    total = 0
    for n, order in enumerate(ORDERS):
        gone = False
        for step, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            fails = bool(mask & bit)
            adds = (not gone and not fails, not gone and fails, gone and fails, mask == bit)
            gone |= fails
            for counter, one in enumerate(adds):
                total += one << FIELD_BITS * ((n * STEPS + step) * len(COUNTERS) + counter)
    return total


def unpacked(total: int) -> np.ndarray:
    """The fields of a sum as an array [outcome, counter]."""
    size = OUTCOMES * len(COUNTERS) * FIELD_BITS // 8
    return np.frombuffer(total.to_bytes(size, "little"), dtype="<u8").astype(np.int64).reshape(OUTCOMES, len(COUNTERS))


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id, part, digest, mask`` of every row; bit i of ``mask`` is set if the row fails filter i of ``ABCD``."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    bare = F.btrim("text", F.lit(SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    found = rows.select(
        "doc_id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        words.alias("words"),
        F.length("text").cast("long").alias("chars"),
        F.length(F.translate("text", CAPITALS, "")).cast("long").alias("uncapital"),
        F.col("text").rlike(r"[#$%&*|]").alias("signs"),
    )
    n_words = F.size("words").cast("long")
    failed = [
        n_words < MIN_WORDS,
        100 * F.size(F.array_distinct("words")).cast("long") < DISTINCT_PERCENT * n_words,
        100 * (F.col("chars") - F.col("uncapital")) > CAPITAL_PERCENT * F.col("chars"),
        F.col("signs"),
    ]
    mask = [F.when(one, F.lit(1 << i)).otherwise(F.lit(0)) for i, one in enumerate(failed)]
    return found.select("doc_id", "part", "digest", sum(mask[1:], mask[0]).alias("mask"))


def counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of every mask, those of good quality and the toxic ones.

    ``rows`` as :func:`failures` gives them, read several times; here the mask gets the bit of filter E. The least id of a
    digest is joined on digest and id together, so a text that a third of the table shares is no hot key.
    """
    first = rows.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (
        rows.join(first, ["digest", "doc_id"], "left")
        .join(marks, "doc_id", "left")
        .withColumn("mask", F.col("mask") + F.when(copy, F.lit(1 << FILTERS.index("E"))).otherwise(F.lit(0)))
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a part with its counted masks -> a row for every outcome of the part."""
    integers = [packed(mask) for mask in range(1 << len(FILTERS))]
    order = pa.array(np.repeat(ORDERS, STEPS))
    step = pa.array(np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)))
    filter_of = np.array([FILTERS.index(name) for one in ORDERS for name in one])
    for batch in batches:
        for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            every, good, toxic = (
                unpacked(sum(integers[m["mask"]] * m[weight] for m in masks)) for weight in ("n", "good", "toxic")
            )
            removed = every[:, COUNTERS.index("removed")]
            share = np.zeros(len(FILTERS), np.int64)
            np.add.at(share, filter_of, removed)
            lost = [one[:, COUNTERS.index("removed")] for one in (good, toxic)]
            columns = [*every.T, *lost, share[filter_of]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * OUTCOMES, pa.string()), order, step, *(pa.array(c, pa.int64()) for c in columns)],
                [c.split()[0] for c in SCHEMA.split(", ")],
            )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``kept`` and ``removed`` documents of the step, ``redundant`` ones that fail its filter but were gone before,
    ``unique_fails`` that fail no other filter, ``good_lost`` and ``toxic_lost`` of the removed by their labels, and
    ``shapley``: what the step's filter removes, summed over all orders.
    """
    counted = counts(kept(failures(docs), "filter-masks"), labels)
    parts = counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return parts.mapInArrow(_outcomes, SCHEMA)
