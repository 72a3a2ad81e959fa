"""Near-duplicate vectors by NN-descent.

Vectors with equal labels link if their cosine is at least ``THRESHOLD``. The search keeps a list of near
neighbours per vector and refines it: the neighbours (and reverse neighbours) of a vector are compared with one
another, which finds neighbours of neighbours, until few lists change. Lists start from windows over vectors
sorted by random-hyperplane codes. A list that is full of links is saturated and doubles its room, up to
``MAX_ROOM``. What a list has no room for still counts as a link: every comparison hands on a spanning forest of
the links it saw. Then the search alone is audited: a hashed set of at most ``AUDIT`` vectors is compared with all
vectors of their label, and every link between two components is a miss. The audit adds no links, so small and large
tables go one way. After a miss another search with fresh codes follows on top of the lists so far; if the last of
``SEARCHES`` still misses a link, all vectors of a label are compared in blocks, exactly.

Links of at least the threshold give the components. Lists cannot hold all links of a large dense group, so every
component is compared within itself in blocks, exactly and in double precision, and only sums of
links leave a block. A component is dealt as pairs of blocks, a neighbour list in chunks, so no task
holds a group whole.

Equal vectors of one label are one point with a weight. Vectors that are NULL, zero, or hold a NULL, NaN or
infinite component, and vectors with a NULL label, link with nothing; vectors of different length never link. Rows
with a NULL id count as vectors; a component of such rows alone has a NULL id. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkatlas.llm.components import connected
from talkatlas.llm.tables import kept

THRESHOLD = 0.93
ROOM = 10
MAX_ROOM = 40
CODE_BITS = 32
TABLES = 6
REACH = 8
ROUNDS = 4
CHANGED = 0.05
AUDIT = 1000
SEARCHES = 4
CHUNK = 64
BLOCK = 512


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of a list column (all of one length) in double precision, with length 1."""
    flat = column.flatten().to_numpy().astype(float).reshape(len(column), -1)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _codes(seed: int):
    """Per vector and table: the signs of its products with random directions."""

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("dim").to_numpy()
            for dim in np.unique(size):
                own = batch.take(pa.array(np.flatnonzero(size == dim)))
                unit = _unit(own.column("vector"))
                rng = np.random.default_rng([seed, int(dim)])
                for number in range(TABLES):
                    signs = unit @ rng.normal(size=(int(dim), CODE_BITS)) > 0
                    code = signs.astype(np.int64) @ (np.int64(1) << np.arange(CODE_BITS, dtype=np.int64)[::-1])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(code), number), pa.int32()), pa.array(code), *own.columns],
                        ["number", "code", *own.schema.names],
                    )

    return codes


SEEN = "node long, other long, sim double, bridge boolean"


def _edges(node: np.ndarray, other: np.ndarray, sim: np.ndarray | None = None) -> pa.RecordBatch:
    """Candidates for the lists, or without ``sim`` bridges: links that only join components."""
    n = len(node)
    sims = pa.nulls(n, pa.float64()) if sim is None else pa.array(sim)
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(other), sims, pa.array(np.full(n, sim is None))], ["node", "other", "sim", "bridge"]
    )


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of the links ``a - b`` between ``n`` places as (place, least place of its component)."""
    label = np.arange(n)
    while (label[a] != label[b]).any():
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within REACH places in the order of the codes, in both directions."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        rows = rows.combine_chunks()
        fresh = 0 if held is None else held.num_rows
        held = rows.slice(max(0, rows.num_rows - REACH))
        group = np.stack([rows.column(c).to_numpy() for c in ("number", "label", "dim")])
        node, dim = rows.column("node").to_numpy(), rows.column("dim").to_numpy()
        for size in np.unique(dim):
            own = np.flatnonzero(dim == size)
            unit = _unit(rows.column("vector").combine_chunks().take(pa.array(own)))
            for step in range(1, REACH + 1):
                a, b = np.arange(len(own) - step), np.arange(step, len(own))
                keep = (own[b] >= fresh) & (group[:, own[a]] == group[:, own[b]]).all(axis=0)
                a, b = a[keep], b[keep]
                if len(a):
                    sim = np.einsum("ij,ij->i", unit[a], unit[b])
                    linked = sim >= THRESHOLD
                    if linked.any():
                        child, root = _forest(len(own), a[linked], b[linked])
                        yield _edges(node[own[child]], node[own[root]])
                    yield _edges(np.concatenate([node[own[a]], node[own[b]]]), np.concatenate([node[own[b]], node[own[a]]]), np.concatenate([sim, sim]))


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the members of every centre with one another, chunk by chunk; rows come sorted by centre."""
    held: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
        centre = rows.column("centre").to_numpy()
        last = int(np.searchsorted(centre, centre[-1])) if len(centre) else 0
        last = max(last, rows.num_rows - CHUNK)
        held = rows.slice(last)
        yield from _compare(rows.slice(0, last))
    if held is not None:
        yield from _compare(held)


def _compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    centre, node = rows.column("centre").to_numpy(), rows.column("node").to_numpy()
    fresh, least = rows.column("fresh").to_numpy(zero_copy_only=False), rows.column("least").to_numpy()
    vectors = rows.column("vector").combine_chunks()
    unit = _unit(vectors)
    opens = np.flatnonzero(np.concatenate([[True], centre[1:] != centre[:-1]]))
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    bridges: list[tuple[np.ndarray, np.ndarray]] = []
    for s, e in zip(opens, np.append(opens[1:], len(centre)), strict=True):
        for lo in range(s, e, CHUNK):
            hi = min(e, lo + CHUNK)
            if hi - lo < 2 or not fresh[lo:hi].any():
                continue
            sim = unit[lo:hi] @ unit[lo:hi].T
            wanted = (fresh[lo:hi, None] | fresh[None, lo:hi]) & (node[lo:hi, None] != node[None, lo:hi])
            i, j = np.nonzero(wanted & (sim > least[lo:hi, None]))
            if len(i):
                found.append((node[lo + i], node[lo + j], sim[i, j]))
            i, j = np.nonzero(np.triu(wanted & (sim >= THRESHOLD)))
            if len(i):
                child, root = _forest(hi - lo, i, j)
                bridges.append((node[lo + child], node[lo + root]))
    if bridges:
        yield _edges(*(np.concatenate(c) for c in zip(*bridges, strict=True)))
    if found:
        yield _edges(*(np.concatenate(c) for c in zip(*found, strict=True)))


def _best(edges: DataFrame) -> DataFrame:
    """``node, other, sim, fresh, room, near, bridge``: the nearest of each node, and all bridges.

    A list full of links has twice the room. Rows with ``near`` are the lists; the others are bridges alone.
    """
    once = edges.groupBy("node", "other").agg(
        F.max("sim").alias("sim"),
        F.min("fresh").alias("fresh"),
        F.max("room").alias("room"),
        F.max("bridge").alias("bridge"),
    )
    of_node = Window.partitionBy("node")
    place = F.row_number().over(of_node.orderBy(F.desc_nulls_last("sim"), "other"))
    ranked = once.withColumn("place", place).withColumn("room", F.max("room").over(of_node))
    full = F.sum(((F.col("place") <= F.col("room")) & (F.col("sim") >= THRESHOLD)).cast("int")).over(of_node) >= F.col("room")
    room = F.when(full, F.least(F.col("room") * 2, F.lit(MAX_ROOM))).otherwise(F.col("room"))
    near = F.col("sim").isNotNull() & (F.col("place") <= F.col("room"))
    return ranked.withColumn("room", room).withColumn("near", near).where("near OR bridge").drop("place")


def _round(points: DataFrame, lists: DataFrame, number: int) -> DataFrame:
    """One refinement: neighbours of neighbours join the lists; gives what ``_best`` gives."""
    members = lists.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").unionByName(
        lists.select(F.col("other").alias("centre"), "node", "fresh")
    )
    members = members.groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
    bounds = lists.groupBy("node").agg(
        F.when(F.count(F.lit(1)) >= F.max("room"), F.min("sim")).otherwise(F.lit(-2.0)).alias("least")
    )
    known = kept(points.join(bounds, "node", "left").select("node", "vector", F.coalesce("least", F.lit(-2.0)).alias("least")), "known")
    found = (
        members.join(known, "node")
        .withColumn("turn", F.xxhash64("centre", "node", F.lit(number)))
        .repartition("centre")
        .sortWithinPartitions("centre", "turn")
        .select("centre", "node", "fresh", "least", "vector")
        .mapInArrow(_local_joins, SEEN)
    )
    old = lists.select("node", "other", "sim", F.lit(False).alias("bridge"), F.lit(False).alias("fresh"), "room")
    new = found.withColumn("fresh", F.lit(True)).withColumn("room", F.lit(ROOM))
    return kept(_best(old.unionByName(new)), "lists")


def descend(points: DataFrame, lists: DataFrame | None, seed: int) -> tuple[DataFrame, DataFrame]:
    """Neighbour lists of all points, refined from fresh windows and the lists so far, and links.

    The links join whatever a window or a local join saw to be linked, also where the lists had no room for it.
    """
    order = ["number", "label", "dim", "code", "node"]
    start = (
        points.mapInArrow(_codes(seed), "number int, code long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_windows, SEEN)
        .withColumn("fresh", F.lit(True))
        .withColumn("room", F.lit(ROOM))
    )
    if lists is not None:
        old = lists.select("node", "other", "sim", F.lit(False).alias("bridge"), F.lit(False).alias("fresh"), "room")
        start = start.unionByName(old)
    seen = kept(_best(start), "lists")
    links = seen.where("bridge").select("node", "other")
    for number in range(ROUNDS):
        seen = _round(points, seen.where("near"), number)
        links = links.unionByName(seen.where("bridge").select("node", "other"))
        total, fresh = seen.where("near").agg(F.count(F.lit(1)), F.sum(F.col("fresh").cast("int"))).first()
        if (fresh or 0) <= CHANGED * total:
            break
    lists = seen.where("near")
    return lists, links.unionByName(lists.where(F.col("sim") >= THRESHOLD).select("node", "other"))


def _audit(placed: DataFrame) -> int:
    """The number of links of some vectors that join two components; the vectors are hashed and AUDIT at most.

    ``placed`` has ``node, label, dim, vector, root``.
    """
    n = placed.count()
    share = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(1_000_000))
    asked = placed.where(share < 500_000 * AUDIT // max(n, 1)).select("root", "label", "dim", "vector").limit(AUDIT).collect()
    groups: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    for key in {(r.label, r.dim) for r in asked}:
        own = [r for r in asked if (r.label, r.dim) == key]
        unit = np.array([r.vector for r in own], float)
        groups[key] = np.array([r.root for r in own]), unit / np.linalg.norm(unit, axis=1, keepdims=True)

    def missed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = batch.column("label").to_numpy(), batch.column("dim").to_numpy()
            for key, (roots, unit) in groups.items():
                own = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if len(own):
                    sim = unit @ _unit(batch.column("vector").take(pa.array(own))).T
                    apart = roots[:, None] != batch.column("root").to_numpy()[own][None, :]
                    n_missed = np.count_nonzero((sim >= THRESHOLD) & apart)
                    yield pa.RecordBatch.from_arrays([pa.array([n_missed], pa.int64())], ["missed"])

    return placed.mapInArrow(missed, "missed long").agg(F.coalesce(F.sum("missed"), F.lit(0))).first()[0]


def _in_blocks(work):
    """``work`` on the rows of whole pairs of blocks; rows come sorted by (root, i, j)."""
    keys = ("root", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
            key = np.stack([rows.column(c).to_numpy() for c in keys])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0))
            cut = int(change[-1]) + 1 if len(change) else 0
            held = rows.slice(cut)
            yield from work(rows.slice(0, cut), key[:, :cut])
        if held is not None and held.num_rows:
            yield from work(held, np.stack([held.column(c).to_numpy() for c in keys]))

    return run


def _join(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(node, other): a spanning forest of the links of each pair of blocks."""
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    node, size = rows.column("node").to_numpy(), rows.column("dim").to_numpy()
    opens = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
    for s, e in zip(opens, np.append(opens[1:], len(node)), strict=True):
        for dim in np.unique(size[s:e]):
            at = s + np.flatnonzero(size[s:e] == dim)
            unit = _unit(rows.column("vector").combine_chunks().take(pa.array(at)))
            a, b = np.nonzero(np.triu(unit @ unit.T >= THRESHOLD, 1))
            child, root = _forest(len(at), a, b)
            yield pa.RecordBatch.from_arrays([pa.array(node[at[child]]), pa.array(node[at[root]])], ["node", "other"])


def _count(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
    if not rows.num_rows:
        return
    rows = rows.combine_chunks()
    unit = _unit(rows.column("vector").combine_chunks())
    node, own, weight = (rows.column(c).to_numpy() for c in ("node", "own", "weight"))
    opens = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
    links = np.zeros(len(node), np.int64)
    for s, e in zip(opens, np.append(opens[1:], len(node)), strict=True):
        linked = unit[s:e] @ unit[s:e].T >= THRESHOLD
        if key[1, s] != key[2, s]:  # within a block its own pair counts
            linked &= own[s:e, None] != own[None, s:e]
        np.fill_diagonal(linked, False)
        links[s:e] = linked @ weight[s:e]
    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(links)], ["node", "links"])


def _dealt(members: DataFrame) -> DataFrame:
    """Members of each root as pairs of blocks, each pair in one place."""
    sizes = kept(members.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "sizes")
    parts = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    keys = ["root", "i", "j"]
    dealt = (
        members.join(sizes, "root")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "root", F.least("own", "mate").alias("i"), F.greatest("own", "mate").alias("j"), "own", "node", "dim", "weight", "vector"
        )
    )
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def exact_links(members: DataFrame) -> DataFrame:
    """``node, links`` for ``root, node, dim, vector, weight``: the weight of all links inside each component."""
    counted = _dealt(members).mapInArrow(_in_blocks(_count), "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def all_links(points: DataFrame) -> DataFrame:
    """``node, other`` that join all linked vectors of a label, from comparing each with each; quadratic work."""
    rows = points.select(F.col("label").alias("root"), "node", "dim", F.lit(1).cast("long").alias("weight"), "vector")
    return _dealt(rows).mapInArrow(_in_blocks(_join), "node long, other long")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    numbers = F.col("vector")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = F.col("label").isNotNull() & numbers.isNotNull() & ~bad & F.exists(numbers, lambda x: x != 0)
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector")
    ).withColumns({"valid": F.coalesce(valid, F.lit(False)), "a": F.xxhash64("vector"), "b": F.xxhash64(F.lit(1), "vector")})
    classes = (
        rows.where("valid")
        .groupBy("label", "a", "b")
        .agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
    )
    classes = kept(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")), "classes")
    points = classes.select("node", "label", "dim", "vector")
    lists, links = None, None
    for seed in range(SEARCHES):
        lists, near = descend(points, lists, seed)
        links = near if links is None else near.unionByName(links)
        roots = kept(connected(links, "node", "other"), "roots")
        missed = _audit(points.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
        if not missed:
            break
        links = roots.select("node", F.col("root").alias("other"))
    else:
        roots = kept(connected(all_links(points), "node", "other"), "roots")
    members = kept(roots.join(classes, "node").select("root", "node", "dim", "vector", "weight", "least"), "members")
    counted = exact_links(members)
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    found = kept(roots.join(counted, "node", "left").join(least, "root").select("node", "links", "component_id"), "found")
    result = kept(
        classes.join(found, "node", "left").select(
            F.col("label"),
            "a",
            "b",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component_id", "least").alias("component_id"),
        ),
        "result",
    )
    ids = kept(rows.select("vec_id", "label", "a", "b", "valid"), "ids")
    joined = ids.where("valid").join(result, ["label", "a", "b"]).select("vec_id", "n_links", "component_id")
    alone = ids.where("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = joined.unionByName(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
