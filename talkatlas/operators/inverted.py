"""Neighbours through an inverted file: vectors stored in cells around centroids, of which a search reads a few.

Centroids are fitted on a bounded hashed sample; every row is indexed. A cell is one centroid's list, cut into
bands of the angle to the centroid and dealt into parts of about ``CELL_ROWS`` rows, so a crowded list is many
groups. What goes to every task are the centroids (``LISTS`` at most) and one short record per cell.

Two searches read the index. ``probe`` visits the lists of the nearest centroids; ``tuned_probes`` says how many of them
a wanted recall takes, by exact comparison of a hashed set of queries. ``exact`` visits the nearest lists first and then every cell that may
still hold a better row: by the triangle inequality no row of a cell is nearer to the query than the query's angle
to the centroid, less the widest (or the narrowest, less it) angle in the cell. Its rows are those of ``knn.nearest``.

A visit sends the query to every cell it asks for. Queries that ask for more than ``SCAN_SHARE`` of the lists or rows would be
sent to almost every cell, so they meet all rows block by block instead, in tiles whose number does not follow the number of
cells; what they may not visit is left out inside the tile, so the rows are the same.

Zero vectors have a list of their own and similarity 0 with everything. Rows with a NULL id or without ``dim`` finite values
take no part, neither in the index nor as queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from talkatlas.functions.vector import is_vector
from talkatlas.operators.knn import ROUNDING, _block_rows, _blocks, _local_best, _matrix, _tiled, _unit_rows, nearest
from talkatlas.operators.ranking import top_per_group
from talkatlas.operators.skew import skew_join
from talkatlas.session import stored

LISTS = 16_384
FIT_ROWS_PER_LIST = 64
FIT_STEPS = 8
CELL_ROWS = 8192
QUERY_ROWS = 8192
BANDS = 64
BAND = math.pi / 32
PARTS = 1 << 24
ZERO = -1
AUDIT = 200
RECALL = 0.95
STRIP = 512
SCAN_SHARE = 0.25


@dataclass(frozen=True)
class Cells:
    """What every task holds: the centroids and, per cell, its list, its rows and its narrowest and widest angle."""

    dim: int
    centres: np.ndarray
    cell: np.ndarray
    list_of: np.ndarray
    size: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @property
    def lists(self) -> int:
        return len(self.centres)


@dataclass(frozen=True)
class Index:
    """A stored index and what was read of it."""

    rows: DataFrame
    row_id: str
    columns: tuple[str, ...]
    cells: Cells


def _valid(row_id: str, vector: str, dim: int) -> Column:
    return F.col(row_id).isNotNull() & is_vector(F.col(vector), dim)


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    return _unit_rows(_matrix(pa.chunked_array([column]), dim))


def _hashed_share(row_id: str, wanted: int, n: int, salt: str) -> Column:
    """About ``wanted`` of ``n`` rows, by a hash of the id."""
    return F.pmod(F.xxhash64(row_id, F.lit(salt)), F.lit(1 << 30)) < (wanted << 30) // max(n, 1)


def fit_centres(rows: DataFrame, lists: int, n: int, seed: int) -> np.ndarray:
    """Unit centroids of ``_vector``, fitted on about FIT_ROWS_PER_LIST rows a list."""
    directed = rows.where(F.exists("_vector", lambda x: x != 0))
    sample = directed.where(_hashed_share("_id", FIT_ROWS_PER_LIST * lists, n, f"centres{seed}"))
    sample = stored(sample.select(array_to_vector(F.col("_vector").cast("array<double>")).alias("features")), "centres-sample")
    if sample.isEmpty():
        return np.empty((0, 0))
    model = KMeans(k=max(2, lists), maxIter=FIT_STEPS, seed=seed, distanceMeasure="cosine").fit(sample)
    return _unit_rows(np.array(model.clusterCenters(), float))


def _place(centres: np.ndarray, dim: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(batch.column("_vector"), dim)
            best, angle = np.full(len(unit), ZERO, np.int64), np.zeros(len(unit))
            for at in range(0, len(unit) if len(centres) else 0, STRIP):
                cos = unit[at : at + STRIP] @ centres.T
                own = cos.argmax(axis=1)
                best[at : at + STRIP] = own
                angle[at : at + STRIP] = np.arccos(np.clip(cos[np.arange(len(own)), own], -1, 1))
            zero = ~unit.any(axis=1)
            best[zero], angle[zero] = ZERO, 0.0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best), pa.array(angle)], [*batch.schema.names, "list", "angle"])

    return place


def build_index(
    vectors: DataFrame, path: str, *, row_id: str, vector: str, dim: int, columns: tuple[str, ...] = (), lists: int | None = None, seed: int = 42
) -> None:
    """Write the index of ``vectors`` under ``path``; ``lists`` defaults to the square root of the rows, ``LISTS`` at most."""
    named = [F.col(c).alias(f"_c_{c}") for c in columns]
    rows = vectors.where(_valid(row_id, vector, dim)).select(F.col(row_id).alias("_id"), F.col(vector).alias("_vector"), *named)
    n = rows.count()
    lists = min(LISTS, max(1, math.isqrt(n))) if lists is None else lists
    centres = fit_centres(rows, lists, n, seed)
    schema = T.StructType([*rows.schema, T.StructField("list", T.LongType()), T.StructField("angle", T.DoubleType())])
    placed = stored(rows.mapInArrow(_place(centres, dim), schema), "placed")
    placed = placed.withColumn("place", (F.col("list") * BANDS + F.floor(F.col("angle") / BAND)).cast("long"))
    parts = placed.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / F.lit(CELL_ROWS)).alias("parts"))
    cell = F.col("place") * PARTS + F.pmod(F.xxhash64("_id", F.lit("part")), F.col("parts"))
    dealt = skew_join(placed, parts, "place").withColumn("cell", cell).drop("place", "parts")
    dealt.repartitionByRange("cell").sortWithinPartitions("cell").write.parquet(f"{path}/rows")
    spark = vectors.sparkSession
    cells = spark.read.parquet(f"{path}/rows").groupBy("cell", "list").agg(
        F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high")
    )
    cells.write.parquet(f"{path}/cells")
    kept = [(i, c.tolist()) for i, c in enumerate(centres)]
    spark.createDataFrame(kept, "list long, centre array<double>").write.parquet(f"{path}/centres")


def open_index(spark: SparkSession, path: str, *, row_id: str, dim: int, columns: tuple[str, ...] = ()) -> Index:
    """The index under ``path``. Centroids and cells are read whole: they are bounded by ``LISTS`` and one record per CELL_ROWS rows or band."""
    centres = spark.read.parquet(f"{path}/centres").orderBy("list").toArrow()["centre"].to_pylist()
    cells = spark.read.parquet(f"{path}/cells").orderBy("list", "cell").toArrow()
    matrix = np.array(centres, float).reshape(len(centres), dim)
    read = Cells(dim, matrix, *(cells[c].to_numpy() for c in ("cell", "list", "n", "low", "high")))
    return Index(spark.read.parquet(f"{path}/rows"), row_id, columns, read)


def _per_query(queries: DataFrame, work, column: str, kind: str) -> DataFrame:
    """``queries`` with one more column, an array that ``work`` makes of each Arrow batch."""
    schema = T.StructType([*queries.schema, T.StructField(column, T._parse_datatype_string(kind))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(work(part), arrow.field(column).type)], schema=arrow)

    return queries.mapInArrow(run, schema)


def _order(cells: Cells, batch: pa.RecordBatch) -> np.ndarray:
    """Lists of each query, nearest centroid first."""
    return np.argsort(-(_unit(batch.column("_vector"), cells.dim) @ cells.centres.T), axis=1, kind="stable")


def _first_cells(cells: Cells, probes: int):
    """Cells of the nearest lists; all cells if no list is left out."""
    opens = np.searchsorted(cells.list_of, np.arange(cells.lists))
    ends = np.searchsorted(cells.list_of, np.arange(cells.lists), "right")

    def work(batch: pa.RecordBatch) -> list[np.ndarray]:
        if probes >= cells.lists:
            return [cells.cell] * batch.num_rows
        order = _order(cells, batch)[:, :probes]
        return [np.concatenate([cells.cell[opens[x] : ends[x]] for x in row]) for row in order]

    return work


def _open_cells(cells: Cells):
    """Cells that were not visited and whose rows may reach the similarity ``kth``; nothing if they hold too large a share of all rows."""
    few = SCAN_SHARE * cells.size.sum()

    def work(batch: pa.RecordBatch) -> list[np.ndarray | None]:
        unit = _unit(batch.column("_vector"), cells.dim)
        zero = ~unit.any(axis=1)
        cos = np.concatenate([unit @ cells.centres.T, np.zeros((len(unit), 1))], axis=1)  # the last is that of ZERO
        angle = np.arccos(np.clip(cos, -1, 1))[:, cells.list_of]
        apart = np.maximum(0, np.maximum(cells.low - angle, angle - cells.high))
        bound = np.where((cells.list_of == ZERO)[None, :] | zero[:, None], 0.0, np.cos(apart))
        kth = batch.column("kth").to_numpy(zero_copy_only=False).astype(float)
        reach = ~(bound < kth[:, None] - 2 * ROUNDING)  # kth is not a number where fewer than k rows are known
        visited = batch.column("cells")
        more = [row & ~np.isin(cells.cell, seen.values.to_numpy()) for row, seen in zip(reach, visited, strict=True)]
        return [cells.cell[row] if cells.size[row].sum() <= few else None for row in more]

    return work


def _asked(queries: DataFrame, index: Index, vector: str, query_columns: tuple[str, ...]) -> DataFrame:
    named = [F.col(c).alias(f"_q_{c}") for c in query_columns]
    return queries.where(_valid(index.row_id, vector, index.cells.dim)).select(F.col(index.row_id).alias("_id"), F.col(vector).alias("_vector"), *named)


def _outside(cells: Cells, probes: int):
    """Pairs of a query and a row that is in none of the query's ``probes`` nearest lists."""

    def closed(part: pa.Table, rows: pa.Table) -> np.ndarray:
        unit = _unit_rows(_matrix(part["_vector"], cells.dim))
        order = np.argsort(-(unit @ cells.centres.T), axis=1, kind="stable")[:, :probes]
        shut = np.ones((len(unit), cells.lists + 1), bool)  # the last is that of ZERO
        np.put_along_axis(shut, order, False, axis=1)
        return shut[:, rows["list"].to_numpy()]

    return closed


def _scan(asked: DataFrame, index: Index, k: int, query_columns: tuple[str, ...], closed=None) -> DataFrame:
    """Best ``k`` rows of every query and block of rows, but for the pairs that ``closed`` marks. No cell is asked for by name."""
    carried = [f"_q_{c}" for c in query_columns], [f"_c_{c}" for c in index.columns]
    dim, n, held = index.cells.dim, asked.count(), int(index.cells.size.sum())
    per_block = _block_rows(dim, max(n, held), asked.sparkSession.sparkContext.defaultParallelism)
    schema = _scored_schema(asked, index, carried)
    rows = index.rows.select("_id", "_vector", *carried[1], "list")
    return _tiled(
        asked.select("_id", "_vector", *carried[0]), rows, _blocks(n, per_block), _blocks(held, per_block), k, dim, "cosine", None,
        carried, schema, to_arrow_schema(schema), closed,
    )


def _scored_schema(asked: DataFrame, index: Index, carried: tuple[list[str], list[str]]) -> T.StructType:
    out = [T.StructField("_id", asked.schema["_id"].dataType)]
    out += [T.StructField(c, asked.schema[c].dataType) for c in carried[0]]
    out += [T.StructField("_other", index.rows.schema["_id"].dataType)]
    out += [T.StructField(c, index.rows.schema[c].dataType) for c in carried[1]]
    return T.StructType([*out, T.StructField("score", T.DoubleType())])


def _visit(planned: DataFrame, index: Index, k: int, query_columns: tuple[str, ...]) -> DataFrame:
    """Best ``k`` rows of every query and cell; ``planned`` has the queries with their ``cells``.

    Cells that nobody asks for are not read past their key. A cell that many queries ask for meets them part by part.
    """
    carried = [f"_q_{c}" for c in query_columns], [f"_c_{c}" for c in index.columns]
    asked = planned.select("_id", "_vector", *carried[0], F.explode("cells").alias("cell"))
    load = stored(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERY_ROWS)).cast("int").alias("parts")), "load")
    load = F.broadcast(load)  # one record per cell, as every task holds already
    part = F.pmod(F.xxhash64("_id", F.lit("query")), F.col("parts")).cast("int")
    left = asked.join(load, "cell").withColumn("part", part).drop("parts")
    copies = load.select(F.col("cell").alias("cell"), F.sequence(F.lit(0), F.col("parts") - 1).alias("copies"))
    right = index.rows.drop("list", "angle").join(copies, "cell").withColumn("part", F.explode("copies")).drop("copies")
    schema = _scored_schema(planned, index, carried)
    arrow, dim = to_arrow_schema(schema), index.cells.dim

    def tile(a: pa.Table, b: pa.Table) -> pa.Table:
        return _local_best(a, b, k, dim, "cosine", None, carried, arrow)

    return left.groupBy("cell", "part").cogroup(right.groupBy("cell", "part")).applyInArrow(tile, schema)


def _ranked(scored: DataFrame, index: Index, k: int, query_columns: tuple[str, ...]) -> DataFrame:
    best = top_per_group(scored, ["_id"], [F.desc("score"), F.asc("_other")], k)
    names = {"_id": f"query_{index.row_id}", "_other": index.row_id} | {f"_q_{c}": f"query_{c}" for c in query_columns}
    return best.withColumnsRenamed(names | {f"_c_{c}": c for c in index.columns})


def probe(
    index: Index, queries: DataFrame, k: int, *, vector: str, probes: int, query_columns: tuple[str, ...] = ()
) -> DataFrame:
    """The ``k`` nearest rows of every query among the lists of its ``probes`` nearest centroids; columns as ``knn.nearest``."""
    if probes < 1:
        raise ValueError("probes must be at least 1")
    asked = _asked(queries, index, vector, query_columns)
    if probes > SCAN_SHARE * index.cells.lists:
        closed = None if probes >= index.cells.lists else _outside(index.cells, probes)
        return _ranked(_scan(asked, index, k, query_columns, closed), index, k, query_columns)
    planned = stored(_per_query(asked, _first_cells(index.cells, probes), "cells", "array<long>"), "planned")
    return _ranked(_visit(planned, index, k, query_columns), index, k, query_columns)


def tuned_probes(index: Index, queries: DataFrame, k: int, *, vector: str, recall: float = RECALL) -> tuple[int, float]:
    """How many lists to visit, and the recall that gives among the audited queries.

    About AUDIT hashed queries are compared with all rows. A true neighbour is found if its list is visited, so the place of
    its list in the query's order says from how many lists on; the fewest that reach ``recall`` are returned.
    A neighbour that is a zero vector is found only where all lists are visited.
    """
    asked = _asked(queries, index, vector, ())
    n = asked.count()
    asked = stored(asked.where(_hashed_share("_id", AUDIT, n, "audit")) if n > AUDIT else asked, "audited")
    truth = nearest(
        asked, index.rows, k, row_id="_id", vector="_vector", dim=index.cells.dim, columns=("list",), strategy="broadcast"
    ).select(F.col("query__id").alias("_id"), "list")

    cells = index.cells

    def order(batch: pa.RecordBatch) -> list[np.ndarray]:
        return list(_order(cells, batch))

    placed = _per_query(asked, order, "order", "array<long>").select("_id", F.posexplode("order").alias("place", "list"))
    needed = truth.join(placed, ["_id", "list"], "left").groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()
    total = sum(r.n for r in needed)
    found = 0
    for r in sorted((r for r in needed if r.place is not None), key=lambda r: r.place):
        found += r.n
        if found >= recall * total:
            return r.place + 1, found / total
    return max(1, index.cells.lists), 1.0


def exact(
    index: Index, queries: DataFrame, k: int, *, vector: str, probes: int = 2, query_columns: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``knn.nearest``, and one row ``n_compared, n_pairs``: pairs of a query and a row that were compared, of all."""
    asked = _asked(queries, index, vector, query_columns)
    planned = stored(_per_query(asked, _first_cells(index.cells, probes), "cells", "array<long>"), "planned")
    first = stored(top_per_group(_visit(planned, index, k, query_columns), ["_id"], [F.desc("score"), F.asc("_other")], k), "first")
    kth = first.where(F.col("rank") == k).select("_id", F.col("score").alias("kth"))
    bounded = planned.join(kth.distinct(), "_id", "left")
    rest = _per_query(bounded, _open_cells(index.cells), "more", "array<long>")
    rest = stored(rest.drop("cells", "kth").withColumnRenamed("more", "cells"), "rest")
    wide = stored(rest.where(F.col("cells").isNull()).select("_id").distinct(), "wide")
    if wide.isEmpty():
        scored = first.drop("rank").unionByName(_visit(rest, index, k, query_columns))
        compared, scans = (planned, rest), 0
    else:
        # All rows of such an id, its first cells included, come from the scan.
        near = [skew_join(df, wide, "_id", "left_anti") for df in (first, planned, rest)]
        whole = stored(skew_join(asked, wide, "_id", "left_semi"), "scanned")
        scored = near[0].drop("rank").unionByName(_visit(near[2], index, k, query_columns)).unionByName(_scan(whole, index, k, query_columns))
        compared, scans = near[1:], whole.count()
    sizes = index.rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    visits = reduce(DataFrame.unionByName, (df.select(F.explode("cells").alias("cell")) for df in compared))
    visited = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("visits")).join(sizes, "cell")
    held = int(index.cells.size.sum())
    n_compared = F.coalesce(F.sum(F.col("visits") * F.col("n")), F.lit(0)) + F.lit(scans * held)
    work = visited.agg(n_compared.alias("n_compared")).withColumn("n_pairs", planned.agg(F.count(F.lit(1))).scalar() * F.lit(held))
    return _ranked(scored, index, k, query_columns), work
