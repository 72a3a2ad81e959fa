"""Exact nearest neighbours of many queries at once.

A matrix product scores a block of queries against a block of candidates and
hands on only the best ``k`` per query; a ranked window merges those. No pair of
rows is ever a row of its own, and no block grows with the data.

Few queries (by their measured size) are broadcast and the candidates stay where
they are. Otherwise both sides are hashed into blocks of bounded size and every
pair of blocks is one group of one shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from talkatlas.functions.vector import is_vector
from talkatlas.operators.ranking import top_per_group

# Both shuffles of the tiled search, rows in and best rows out, shrink in
# proportion to the block size, so a block is as large as a task can well hold.
BLOCK_BYTES = 64 * 1024 * 1024
STRIP_CELLS = 4_000_000
BROADCAST_BYTES = 16 * 1024 * 1024
DIGITS = 6
ROUNDING = 10.0**-DIGITS
HEAD_COLUMNS = 4096
CROWDED = 128


def _full_block(dim: int) -> int:
    return max(1, BLOCK_BYTES // (max(1, dim) * 8))


def _block_rows(dim: int, rows: int, parallelism: int) -> int:
    """At most BLOCK_BYTES of doubles; less when that keeps all cores busy."""
    spread = math.ceil(rows / max(1, math.isqrt(parallelism)))
    return max(1, min(_full_block(dim), max(256, spread)))


def _blocks(rows: int, per_block: int) -> int:
    return max(1, math.ceil(rows / per_block))


def _block_of(row_id: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(blocks)).cast("int")


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), dim).astype(np.float64)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.einsum("ij,ij->i", m, m))
    return m / np.where(size == 0, 1.0, size)[:, None]


def _scores(q: np.ndarray, c: np.ndarray, metric: str) -> np.ndarray:
    """Larger is nearer: the cosine, or the negative distance."""
    if metric == "cosine":
        return q @ c.T
    sq = np.einsum("ij,ij->i", q, q)[:, None] + np.einsum("ij,ij->i", c, c)[None, :] - 2.0 * (q @ c.T)
    return -np.sqrt(np.maximum(sq, 0.0))


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and rounded scores of the ``k`` best columns per row.

    Columns are in id order, so ties go to the smaller column. The k-th best of the
    first columns, less the rounding step, is a border no better column can fall
    below; it leaves few columns to sort. A row with many ties left is cut without
    sorting them.
    """
    head = min(scores.shape[1], max(HEAD_COLUMNS, k))
    border = np.full(len(scores), np.finfo(np.float64).min)
    if head > k:
        border = np.maximum(border, np.partition(scores[:, :head], head - k, axis=1)[:, head - k] - ROUNDING)
    above = scores >= border[:, None]
    crowded = np.flatnonzero(np.count_nonzero(above, axis=1) > CROWDED * k)
    above[crowded] = False
    rows, cols = np.nonzero(above)
    found = np.round(scores[rows, cols], DIGITS) + 0.0
    order = np.lexsort((cols, -found, rows))
    rows, cols, found = rows[order], cols[order], found[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    pieces = [(rows[keep], cols[keep], found[keep])]
    for row in crowded:
        rounded = np.round(scores[row], DIGITS) + 0.0
        kth = np.partition(rounded, len(rounded) - k)[len(rounded) - k]
        better, equal = np.flatnonzero(rounded > kth), np.flatnonzero(rounded == kth)
        chosen = np.concatenate([better, equal[: k - len(better)]])
        pieces.append((np.full(len(chosen), row), chosen, rounded[chosen]))
    return tuple(np.concatenate(part) for part in zip(*pieces))


def _local_best(
    left: pa.Table, right: pa.Table, k: int, dim: int, metric: str, exclude: str | None, carried: tuple[list, list],
    schema: pa.Schema, closed: Callable[[pa.Table, pa.Table], np.ndarray] | None = None,
) -> pa.Table:
    """Best ``k`` rows of ``right`` for every row of ``left``; ``closed`` marks pairs that must not meet."""
    right = right.sort_by("_id")
    qm, cm = _matrix(left["_vector"], dim), _matrix(right["_vector"], dim)
    if metric == "cosine":
        qm, cm = _unit_rows(qm), _unit_rows(cm)
    c_ids = right["_id"].to_numpy()
    strip = max(1, STRIP_CELLS // max(1, len(cm)))
    pieces = []
    for at in range(0, len(qm), strip) if len(cm) else []:
        part = left.slice(at, strip)
        scores = _scores(qm[at : at + strip], cm, metric)
        ids = part["_id"].to_numpy()
        first, last = np.searchsorted(c_ids, ids, "left"), np.searchsorted(c_ids, ids, "right")
        for row in np.flatnonzero(first < last):
            scores[row, first[row] : last[row]] = -np.inf
        if exclude is not None:
            scores[part[f"_q_{exclude}"].to_numpy()[:, None] == right[f"_c_{exclude}"].to_numpy()[None, :]] = -np.inf
        if closed is not None:
            scores[closed(part, right)] = -np.inf
        rows, cols, found = _best(scores, k)
        mine, theirs = part.take(pa.array(rows)), right.take(pa.array(cols))
        values = found if metric == "cosine" else -found + 0.0
        columns = [mine["_id"], *(mine[c] for c in carried[0]), theirs["_id"], *(theirs[c] for c in carried[1])]
        pieces.append(pa.table([*columns, pa.array(values)], schema=schema))
    return pa.concat_tables(pieces) if pieces else schema.empty_table()


def nearest(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    *,
    row_id: str,
    vector: str,
    dim: int,
    metric: str = "cosine",
    exclude: str | None = None,
    query_columns: tuple[str, ...] = (),
    columns: tuple[str, ...] = (),
    block_rows: int | None = None,
    strategy: str = "measured",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The ``k`` nearest candidates of every query, exactly.

    A query never meets the row with its own id. ``exclude`` names a column that
    must differ as well (a cross-validation fold). Scores are rounded to six
    digits before ranking; ties go to the smaller id. Rows take no part, as
    queries or as candidates, if their id is NULL or their vector does not have
    ``dim`` finite values. ``strategy`` is ``broadcast`` for the queries, ``tiled``, or
    ``measured``: broadcast up to ``broadcast_bytes``. All give the same rows. The result has ``query_<id>``,
    ``query_<column>...``, ``<id>``, ``<column>...``, ``score`` and ``rank``; for
    ``euclidean`` the score is the distance.
    """
    if metric not in ("cosine", "euclidean"):
        raise ValueError(f"unknown metric {metric}")
    if strategy not in ("measured", "broadcast", "tiled"):
        raise ValueError(f"unknown strategy {strategy}")
    shared = [] if exclude is None else [exclude]
    valid = F.col(row_id).isNotNull() & is_vector(F.col(vector), dim)

    def side(df: DataFrame, prefix: str, names: tuple[str, ...]) -> DataFrame:
        carried = [F.col(c).alias(f"{prefix}{c}") for c in dict.fromkeys([*names, *shared])]
        return df.where(valid).select(F.col(row_id).alias("_id"), F.col(vector).alias("_vector"), *carried)

    q, c = side(queries, "_q_", query_columns), side(candidates, "_c_", columns)
    out = [(f"query_{row_id}", queries.schema[row_id])]
    out += [(f"query_{name}", queries.schema[name]) for name in query_columns]
    out += [(row_id, candidates.schema[row_id]), *((name, candidates.schema[name]) for name in columns)]
    schema = T.StructType([T.StructField(name, f.dataType) for name, f in out] + [T.StructField("score", T.DoubleType())])
    arrow_schema = to_arrow_schema(schema)
    carried = [f"_q_{name}" for name in query_columns], [f"_c_{name}" for name in columns]

    n_queries, query_bytes = _measure(q, dim)
    if strategy == "broadcast" or (strategy == "measured" and query_bytes <= broadcast_bytes):
        local = _against_broadcast(q, c, k, dim, metric, exclude, carried, schema, arrow_schema)
    else:
        n_candidates = c.count()
        if block_rows is None:
            parallelism = queries.sparkSession.sparkContext.defaultParallelism
            block_rows = _block_rows(dim, max(n_queries, n_candidates), parallelism)
        local = _tiled(
            q, c, _blocks(n_queries, block_rows), _blocks(n_candidates, block_rows), k, dim, metric, exclude, carried,
            schema, arrow_schema,
        )
    nearer = F.asc("score") if metric == "euclidean" else F.desc("score")
    return top_per_group(local, [f"query_{row_id}"], [nearer, F.asc(row_id)], k)


def _measure(q: DataFrame, dim: int) -> tuple[int, int]:
    """Rows of ``q`` and an upper bound of their bytes, carried strings included."""
    carried = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in q.columns if c != "_vector"]
    n, extra = q.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(carried, F.lit(0))), F.lit(0))).first()
    return n, n * dim * 8 + extra


def _against_broadcast(q, c, k, dim, metric, exclude, carried, schema, arrow_schema) -> DataFrame:
    """Candidates stay in their partitions; each meets the broadcast queries."""
    shared_queries = q.sparkSession.sparkContext.broadcast(q.toArrow())
    full_block = _full_block(dim)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[pa.RecordBatch] = []
        rows = 0

        def scored() -> Iterator[pa.RecordBatch]:
            right = pa.Table.from_batches(block)
            best = _local_best(shared_queries.value, right, k, dim, metric, exclude, carried, arrow_schema)
            yield from best.to_batches()

        for batch in batches:
            block.append(batch)
            rows += batch.num_rows
            if rows >= full_block:
                yield from scored()
                block, rows = [], 0
        if rows:
            yield from scored()

    return c.mapInArrow(scan, schema)


def _tiled(q, c, q_blocks, c_blocks, k, dim, metric, exclude, carried, schema, arrow_schema, closed=None) -> DataFrame:
    """Every block of queries meets every block of candidates in a group of its own."""
    q = q.withColumn("_qb", _block_of("_id", q_blocks)).withColumn(
        "_cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))
    )
    c = c.withColumn("_cb", _block_of("_id", c_blocks)).withColumn(
        "_qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))
    )

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        return _local_best(left, right, k, dim, metric, exclude, carried, arrow_schema, closed)

    return q.groupBy("_qb", "_cb").cogroup(c.groupBy("_qb", "_cb")).applyInArrow(tile, schema)
