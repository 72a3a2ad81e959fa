"""Hard negatives of anchors by a vertical scan of column blocks.

Every component becomes an integer, ``floor(scale * x)``; a score is the exact integer inner product. An anchor's
positives are its best rows of the same label. For a positive of score p, its negatives are the best rows of other labels
whose score n lies in the window ``low * p <= 100 * n <= high * p``. Higher scores come first, ties by smaller id.

1. Rows are dealt by a hash of their id to blocks of about ``BLOCK_ROWS``, and each block is written as columns: one row a
   dimension, with the least and the greatest value of the block, in the narrowest integers that hold them.
2. Blocks of anchors meet blocks of columns. An anchor reads the dimensions in the descending order of its own magnitudes. After
   every ``STRIDE`` of them, what the unread ones can still add at least and at most gives each candidate a lower and an
   upper bound, and candidates whose bounds shut them out leave the bitmap. What is left at the end has its exact score.
3. Each pair of blocks hands on the best few rows of every anchor (and positive), and the best of these are the result.

The first scan finds positives: a candidate leaves when its upper bound is below the lower bound of the k-th best. The second finds
negatives for all windows of an anchor at once: a candidate leaves when it can be in no window, or not among the
first k of those sure to be in it.

No part is taken by rows with a NULL id, label or vector, or with a component that is NULL or not finite. Of several
rows with one id the least (label, components) counts. Vectors of different lengths never meet. Integers beyond 64 bits
are held at the ends of that range; sums are exact and held there only in the result. A positive of negative score has an
empty window. An empty table, or one without anchors, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm.tables import kept
from talkatlas.operators.ranking import top_per_group

BLOCK_ROWS = 16_384
ANCHOR_ROWS = 1_024
STRIDE = 8
IDS, LABELS = -1, -2  # rows of a block that are no dimension
LONG = np.iinfo(np.int64)
COLUMNS = "dim int, block int, axis int, low long, high long, width int, column binary"
POSITIVES = "anchor_id long, positive_id long, positive_score long"
NEGATIVES = POSITIVES + ", negative_id long, negative_score long"


def _integers(scale: int):
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """id, label, vector, anchor -> the rows that take part, their components as 64-bit integers."""
        for batch in batches:
            vectors = batch.column(2)
            if isinstance(vectors, pa.FixedSizeListArray):
                vectors = vectors.cast(pa.list_(vectors.type.value_type))
            sizes = vectors.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            values = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(sizes)])
            wrong = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            good = (wrong[first[1:]] == wrong[first[:-1]]) & np.asarray(vectors.is_valid())
            whole = np.floor(np.nan_to_num(values) * scale)
            high = whole >= 2.0**63
            whole = np.where(high, 0.0, np.maximum(whole, -(2.0**63))).astype("<i8")
            whole[high] = LONG.max
            rows = np.flatnonzero(good)
            parts = [whole[first[r] : first[r + 1]].tobytes() for r in rows]
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), taken.column(1), pa.array(sizes[rows], pa.int32()), pa.array(parts, pa.binary()), taken.column(3)],
                ["id", "label", "dim", "parts", "anchor"],
            )

    return convert


def _matrix(parts: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(parts.to_pylist()), dtype="<i8").reshape(len(parts), dim)


def _columnar(rows: pa.Table) -> pa.Table:
    """The rows of a block -> its columns: ids, labels and one per dimension."""
    dim, block = rows["dim"][0].as_py(), rows["block"][0].as_py()
    rows = rows.sort_by("id")
    axes = [(IDS, rows["id"].to_numpy()), (LABELS, rows["label"].to_numpy())]
    axes += list(enumerate(_matrix(rows["parts"], dim).T))
    out = []
    for axis, values in axes:
        low, high = int(values.min()), int(values.max())
        width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
        out.append((dim, block, axis, low, high, width, values.astype(f"<i{width}").tobytes()))
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return pa.table([pa.array(v, k) for v, k in zip(zip(*out), kinds, strict=True)], names=names)


class Block:
    """Columns of a block, its ids ascending."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by("axis")
        wide = [
            np.frombuffer(c, dtype=f"<i{w}").astype(np.int64)
            for c, w in zip(rows["column"].to_pylist(), rows["width"].to_pylist(), strict=True)
        ]
        self.labels, self.ids, self.columns = wide[0], wide[1], wide[2:]
        self.low, self.high = rows["low"].to_pylist()[2:], rows["high"].to_pylist()[2:]

    def scan(self, query: list[int], bitmap: np.ndarray, shut_out) -> tuple[np.ndarray, np.ndarray]:
        """Rows that stay in ``bitmap`` and their exact scores.

        ``shut_out(at_least, at_most)`` tells from the bounds of the rows that are left which of them go.
        """
        order = sorted(range(len(query)), key=lambda d: -abs(query[d]))
        ends = [sorted((query[d] * self.low[d], query[d] * self.high[d])) for d in order]
        exact = sum(max(abs(a), abs(b)) for a, b in ends) < 1 << 62
        rows = np.flatnonzero(bitmap)
        score = np.zeros(len(rows), np.int64 if exact else object)
        for at in range(0, len(order), STRIDE):
            for d in order[at : at + STRIDE]:
                score = score + query[d] * (self.columns[d][rows] if exact else self.columns[d][rows].astype(object))
            left = ends[at + STRIDE :]
            gone = shut_out(score + sum(a for a, _ in left), score + sum(b for _, b in left))
            if gone.any():
                bitmap[rows[gone]] = False
                rows, score = np.flatnonzero(bitmap), score[~gone]
            if not len(rows):
                break
        return rows, score

    def positives(self, query: list[int], label: int, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` rows of the label but ``own``: ids and scores."""

        def shut_out(at_least, at_most):
            if len(at_least) <= k:
                return np.zeros(len(at_least), bool)
            return (at_most < _kth(at_least, k)).astype(bool)

        rows, score = self.scan(query, (self.labels == label) & (self.ids != own), shut_out)
        first = np.argsort(-score, kind="stable")[:k]
        return self.ids[rows[first]], score[first]

    def negatives(self, query: list[int], label: int, windows: list[tuple[int, int]], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each window the first ``k`` rows of other labels in it: ids and scores."""

        def shut_out(at_least, at_most):
            stays = np.zeros(len(at_least), bool)
            for low, high in windows:
                may = (at_most >= low) & (at_least <= high)
                sure = (at_least >= low) & (at_most <= high)
                if np.count_nonzero(sure) > k:
                    may &= at_most >= _kth(at_least[sure.astype(bool)], k)
                stays |= may.astype(bool)
            return ~stays

        rows, score = self.scan(query, self.labels != label, shut_out)
        for low, high in windows:
            inside = np.flatnonzero((score >= low) & (score <= high))
            first = inside[np.argsort(-score[inside], kind="stable")[:k]]
            yield self.ids[rows[first]], score[first]


def _kth(values: np.ndarray, k: int):
    """The k-th greatest value."""
    return np.partition(values, len(values) - k)[len(values) - k] if values.dtype != object else sorted(values)[-k]


def _table(columns: list[list], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    held = [[min(max(int(v), LONG.min), LONG.max) for v in column] for column in columns]
    return pa.table([pa.array(column, pa.int64()) for column in held], names=names)


def _find_positives(k: int):
    def task(columns: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if columns.num_rows and anchors.num_rows:
            block = Block(columns)
            queries = _matrix(anchors["parts"], anchors["dim"][0].as_py()).tolist()
            for own, label, query in zip(anchors["id"].to_pylist(), anchors["label"].to_pylist(), queries, strict=True):
                ids, score = block.positives(query, label, own, k)
                for column, values in zip(out, ([own] * len(ids), ids.tolist(), score.tolist()), strict=True):
                    column += values
        return _table(out, POSITIVES)

    return task


def _find_negatives(k: int, low: int, high: int):
    def task(columns: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if columns.num_rows and anchors.num_rows:
            block = Block(columns)
            queries = _matrix(anchors["parts"], anchors["dim"][0].as_py()).tolist()
            rest = (anchors[c].to_pylist() for c in ("id", "label", "positives"))
            for own, label, positives, query in zip(*rest, queries, strict=True):
                scores = [p["positive_score"] for p in positives]
                windows = {s: (-(-low * s // 100), high * s // 100) for s in scores}
                found = dict(zip(windows, block.negatives(query, label, list(windows.values()), k), strict=True))
                for p in positives:
                    ids, score = found[p["positive_score"]]
                    same = [own], [p["positive_id"]], [p["positive_score"]]
                    for column, values in zip(out, (*(v * len(ids) for v in same), ids.tolist(), score.tolist()), strict=True):
                        column += values
        return _table(out, NEGATIVES)

    return task


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    row_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: negatives of all rows with ``is_anchor``."""
    rows = vectors.select(
        F.col(row_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    whole = rows.mapInArrow(_integers(scale), "id long, label long, dim int, parts binary, anchor boolean")
    one = whole.groupBy("id").agg(F.min(F.struct("label", "dim", "parts", "anchor")).alias("row"))
    whole = kept(one.select("id", "row.*"), "vectors")
    n, m = whole.agg(F.count(F.lit(1)), F.count(F.when(F.col("anchor"), 1))).first()
    blocks, anchor_blocks = max(1, -(-n // block_rows)), max(1, -(-m // anchor_rows))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")

    def all_of(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    keys = ["dim", "block", "among"]
    columns = kept(
        whole.select("id", "label", "dim", "parts", dealt(blocks).alias("block")).groupBy("dim", "block").applyInArrow(_columnar, COLUMNS),
        "columns",
    ).withColumn("among", all_of(anchor_blocks))
    anchors = whole.where("anchor").drop("anchor").withColumn("among", dealt(anchor_blocks))

    def meet(queries: DataFrame, task, schema: str) -> DataFrame:
        spread = queries.withColumn("block", all_of(blocks))
        return columns.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(task, schema)

    nearest = top_per_group(
        meet(anchors, _find_positives(n_positives), POSITIVES),
        ["anchor_id"],
        [F.desc("positive_score"), F.asc("positive_id")],
        n_positives,
    )
    positives = kept(
        nearest.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives")),
        "positives",
    )
    negatives = top_per_group(
        meet(anchors.join(positives, "id"), _find_negatives(n_negatives, low, high), NEGATIVES),
        ["anchor_id", "positive_id"],
        [F.desc("negative_score"), F.asc("negative_id")],
        n_negatives,
    )
    return negatives.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
