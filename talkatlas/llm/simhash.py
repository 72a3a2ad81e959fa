"""SimHash near-duplicates by segment bit counts and a grid range join.

A fingerprint is cut into 16 segments of 4 bits; the bit counts of the segments are a point
with 16 coordinates. The Manhattan distance of two points is never larger than the number of
differing bits. Two fingerprints that differ in at most 4 bits differ in at most 2 in one half, so
in the 8 coordinates of that half their points lie within Manhattan distance 2, and some
grid point lies within 1 of both. Every fingerprint therefore visits its own cell and the
cells one step away, in each half; fingerprints that meet in a cell are compared exactly.

A cell hands on a spanning forest of its links, never its pairs, so a group of near copies
costs rows in proportion to its size. A cell with more than ``CELL_ROWS`` fingerprints is dealt as
pairs of blocks to several tasks.

NULL and wordless texts have fingerprint 0. Equal fingerprints are one node whatever the number
of documents. Documents whose id is NULL are linked like others; a component of such rows alone
has a NULL component id. Repeated rows come back as often as they come in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.components import connected
from talkatlas.llm.tables import kept

SHINGLE = 4
SEED = 42
MAX_BITS = 4
CELL_ROWS = 4096
ROWS_AT_ONCE = 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority bits of the shingle hashes of one whole text, as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = len(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = np.array([digest(line, SEED)], dtype=np.uint64)
    else:
        size = np.fromiter(map(len, words), dtype=np.int64, count=n)
        end = np.cumsum(size + 1) - 1
        start = (end - size)[: n - shingle + 1].tolist()
        end = end[shingle - 1 :].tolist()
        hashes = np.fromiter(
            (digest(line[s:e], SEED) for s, e in zip(start, end, strict=True)), dtype=np.uint64, count=len(start)
        )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [fingerprint(t or b"") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "bits"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, bits`` for every row; the texts are read once and not shuffled."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, bits long")


def segment_counts(bits: Column, half: int) -> Column:
    """Bit counts of the eight 4-bit segments of one half, as the 4-bit digits of one integer."""
    part = F.shiftrightunsigned(bits, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    return (
        part
        - F.shiftrightunsigned(part, 1).bitwiseAND(F.lit(0x77777777))
        - F.shiftrightunsigned(part, 2).bitwiseAND(F.lit(0x33333333))
        - F.shiftrightunsigned(part, 3).bitwiseAND(F.lit(0x11111111))
    )


def _cells(bits: Column) -> Column:
    """Cells (half, point) that a fingerprint visits: its own and those one step away."""
    found = []
    for half in range(2):
        point = segment_counts(bits, half)
        found.append(F.struct(F.lit(half).alias("half"), point.alias("point")))
        for digit in range(8):
            value = F.shiftrightunsigned(point, 4 * digit).bitwiseAND(F.lit(15))
            step = 1 << (4 * digit)
            for sign, inside in ((1, value < 4), (-1, value > 0)):
                found.append(
                    F.when(inside, F.struct(F.lit(half).alias("half"), (point + sign * step).alias("point")))
                )
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def _forest(bits: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of one cell that are linked to another node.

    Every sweep gives a node the smallest label among its links and follows labels one step.
    """
    n = len(bits)
    label = np.arange(n)
    while True:
        before = label.copy()
        for at in range(0, n, ROWS_AT_ONCE):
            near = np.bitwise_count(bits[at : at + ROWS_AT_ONCE, None] ^ bits[None, :]) <= max_bits
            if np.count_nonzero(near) > len(near):
                label[at : at + ROWS_AT_ONCE] = np.where(near, label[None, :], n).min(axis=1)
        label = np.minimum(label, label[label])
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return bits[moved], bits[label[moved]]


def _cell_links(max_bits: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell that is cut by the end of a batch waits for the next."""
        held = None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1).astype(np.int64)
            bits = batch.column(4).to_numpy().view(np.uint64)
            if held is not None:
                key, bits = np.concatenate([held[0], key]), np.concatenate([held[1], bits])
            if not len(bits):
                continue
            opens = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
            held = key[opens[-1] :], bits[opens[-1] :]
            yield from _run_links(bits, opens, max_bits)
        if held is not None:
            yield from _run_links(held[1], np.array([0, len(held[1])]), max_bits)

    return links


def _run_links(bits: np.ndarray, opens: np.ndarray, max_bits: int) -> Iterator[pa.RecordBatch]:
    nodes, roots = [], []
    for s, e in zip(opens[:-1], opens[1:], strict=True):
        if e - s > 1:
            node, root = _forest(bits[s:e], max_bits)
            if len(node):
                nodes.append(node)
                roots.append(root)
    if nodes:
        node, root = np.concatenate(nodes), np.concatenate(roots)
        yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["a", "b"])


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all of the distinct ``bits`` within ``max_bits`` (4 at most)."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the grid finds distances of 4 bits at most")
    visits = prints.select("bits", F.explode(_cells(F.col("bits"))).alias("c")).select(
        F.col("c.half").alias("half"), F.col("c.point").alias("point"), "bits"
    )
    crowded = visits.groupBy("half", "point").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows)
    parts = F.coalesce(F.ceil(F.col("n") / F.lit(cell_rows)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    dealt = (
        visits.join(kept(crowded, "crowded"), ["half", "point"], "left")
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("half", "point", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bits")
    )
    keys = ["half", "point", "i", "j"]
    return (
        dealt.repartition(*keys)
        .sortWithinPartitions(*keys)
        .mapInArrow(_cell_links(max_bits), "a long, b long")
        .distinct()
    )


def near_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs``."""
    prints = kept(fingerprints(docs, doc_id, text), "prints")
    classes = kept(prints.groupBy("bits").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = connected(near_links(classes, max_bits), "a", "b")
    named = classes.join(roots, classes.bits == roots.node, "left").select(
        "bits", "least_id", F.coalesce("root", "bits").alias("root")
    )
    named = kept(named, "named")
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    component = kept(named.join(kept(least, "least"), "root").select("bits", "component_id"), "component")
    return prints.join(component, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stay: of each component, the document with the smallest id.

    Rows with a NULL id always stay, and so do repeated rows of a document that stays.
    """
    groups = near_components(docs)
    gone = kept(groups.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti")


