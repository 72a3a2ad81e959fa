"""Word vectors by skip-gram with hierarchical softmax.

Texts are dealt to shards of bounded size. A shard knows only its own words and the tree nodes on their paths, so neither the
driver nor a task holds the vocabulary. Shards are trained side by side from the same start, and a word's vector is the
mean over the shards, weighted by the word's number of pairs in each.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.operators.ranking import global_rank
from talkatlas.session import stored

WINDOW = 5
SENTENCE = 1000  # words; longer texts are trained in pieces
RATE, LEAST_RATE = 0.025, 0.025e-4
SHARD_BYTES = 16 << 20  # of text
SHARD_TOKENS = 4 << 20
SEGMENT = 2 << 20  # words whose pairs are counted at once
BATCH = 8192  # different pairs per step
UNITS = (8, 16, 32)  # pairs of one word that meet its path in one product
SLAB = 4096  # pairs of units of near path lengths
STATE = "shard long, local int, key long, n long, vec binary"


def code_lengths(counts: dict[int, int]) -> dict[int, int]:
    """Length of a Huffman code -> how many words have it, for a number of words per word count.

    Words of one count are paired in one step, so the work follows the different counts, not the words.
    """
    left = [number for _, number in sorted(counts.items())]
    heap = [(count, run) for run, count in enumerate(sorted(counts))]
    parents: dict[int, tuple[int, list[tuple[int, int]]]] = {}
    while heap:
        weight, run = heapq.heappop(heap)
        if left[run] > 1:
            pairs = left[run] // 2
            left.append(pairs)
            parents[len(left) - 1] = (pairs, [(run, 2 * pairs)])
            left[run] -= 2 * pairs
            heapq.heappush(heap, (2 * weight, len(left) - 1))
            if left[run]:
                heapq.heappush(heap, (weight, run))
        elif heap:
            other_weight, other = heapq.heappop(heap)
            left.append(1)
            parents[len(left) - 1] = (1, [(run, 1), (other, 1)])
            left[other] -= 1
            heapq.heappush(heap, (weight + other_weight, len(left) - 1))
            if left[other]:
                heapq.heappush(heap, (other_weight, other))
    depths: list[dict[int, int]] = [{} for _ in left]
    if left:
        depths[-1] = {0: 1}
    for run in range(len(left) - 1, len(counts) - 1, -1):
        below = [[depth + 1, 2 * number] for depth, number in sorted(depths[run].items())]
        for child, wanted in parents[run][1]:
            while wanted:
                taken = min(wanted, below[-1][1])
                depths[child][below[-1][0]] = depths[child].get(below[-1][0], 0) + taken
                wanted -= taken
                below[-1][1] -= taken
                if not below[-1][1]:
                    below.pop()
    total: dict[int, int] = {}
    for found in depths[: len(counts)]:
        for depth, number in found.items():
            total[depth] = total.get(depth, 0) + number
    return dict(sorted(total.items()))


def codes(rank: np.ndarray, lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Canonical code and its length by the rank of a word, the most frequent first."""
    size = np.array(list(lengths), np.int64)
    number = np.array(list(lengths.values()), np.int64)
    first_rank = np.cumsum(number) - number
    first_code = np.zeros(len(size), np.int64)
    for i in range(1, len(size)):
        first_code[i] = (first_code[i - 1] + number[i - 1]) << (size[i] - size[i - 1])
    at = np.searchsorted(first_rank, rank, side="right") - 1
    return first_code[at] + rank - first_rank[at], size[at]


def paths(code: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Node keys, and by depth and word the place of the node and its wanted output; the place behind the last is no node."""
    depth = np.arange(int(size.max(initial=0)))[:, None]
    on = depth < size
    key = np.where(on, (1 << depth) | (code >> np.maximum(size - depth, 0)), 0)
    nodes, place = np.unique(key[on], return_inverse=True)
    path = np.full(key.shape, len(nodes), np.int32)
    path[on] = place
    return nodes, path, np.where(on, 1 - ((code >> np.maximum(size - 1 - depth, 0)) & 1), 0).astype(np.float32)


def start(key: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """First vectors of words, the same in every task."""
    z = key[:, None].astype(np.uint64) * np.uint64(dim) + np.arange(dim, dtype=np.uint64)
    z += np.uint64(seed % (1 << 32) << 31)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (((z >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / dim).astype(np.float32)


def pair_counts(ids: np.ndarray, sentence: np.ndarray, n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word, neighbour and how often, in the order of words. A word's neighbours reach 1 to ``WINDOW`` places, by chance."""
    reach = rng.integers(1, WINDOW + 1, len(ids))
    keys, stop = np.empty(2 * WINDOW * len(ids), np.int64), 0
    for d in range(1, WINDOW + 1):
        near = sentence[d:] == sentence[:-d]
        a, b = ids[:-d].astype(np.int64), ids[d:].astype(np.int64)
        for word, other, wide in ((a, b, reach[:-d] >= d), (b, a, reach[d:] >= d)):
            on = near & wide
            found = word[on] * n + other[on]
            keys[stop : stop + len(found)] = found
            stop += len(found)
    keys = keys[:stop]
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(np.append(first, len(keys)))
    return keys[first] // n, keys[first] % n, times


def add_to(rows: np.ndarray, slot: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
    """Add gradients to ``rows``: each row's sum, divided by one plus the sum of its curvatures.

    For a row with few gradients that is a plain step; one with many does not overshoot.
    """
    at, bend = np.concatenate([p[0] for p in parts]), np.concatenate([p[2] for p in parts])
    grad = np.concatenate([p[1] for p in parts])
    number = np.arange(len(at))
    slot[at] = number
    last = slot[at]
    often = np.zeros(len(at), bool)
    often[last[last != number]] = True
    alone = np.flatnonzero((last == number) & ~often)
    rows[at[alone]] += grad[alone] / (1 + bend[alone, None])
    which = np.flatnonzero(often)
    if len(which):
        slot[at[which]] = np.arange(len(which))
        more = np.flatnonzero(often[last])
        place, which = slot[at[more]], at[which]
        curved = 1 + np.bincount(place, bend[more], len(which))
        sums = np.empty((rows.shape[1], len(which)), np.float32)
        for total, column in zip(sums, grad[more].T.astype(float, order="C"), strict=True):
            np.divide(np.bincount(place, column, len(which)), curved, out=total, casting="same_kind")
        rows[which] += sums.T
    rows[-1] = 0


def train_counts(
    word: np.ndarray, other: np.ndarray, times: np.ndarray, size: np.ndarray, path: np.ndarray, target: np.ndarray,
    words: np.ndarray, nodes: np.ndarray, rate: Callable[[float], float], rng: np.random.Generator,
) -> None:
    """One pass over counted pairs, in steps of random units: the outputs on a word's path, given the vectors of its neighbours.

    The last rows of ``words`` and ``nodes`` are zero and fill up units and paths.
    """
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    ends = np.append(starts[1:], len(word))
    n = -(-(ends - starts) // UNITS[-1])
    begin = np.repeat(starts, n) + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * UNITS[-1]
    held = np.minimum(np.repeat(ends, n) - begin, UNITS[-1])
    fit = np.searchsorted(UNITS, held)
    units = [(begin[fit == i], held[fit == i], word[begin[fit == i]]) for i in range(len(UNITS))]
    steps = -(-len(word) // BATCH)
    dealt = [np.array_split(rng.permutation(len(u[0])), steps) for u in units]
    word_slot, node_slot = np.zeros(len(words), np.int64), np.zeros(len(nodes), np.int64)
    for step in range(steps):
        alpha = np.float32(rate(step / steps))
        to_words, to_nodes = [], []
        for width, (first, number, owner), part in zip(UNITS, units, dealt, strict=True):
            chosen = np.sort(part[step])
            for at in range(0, len(chosen), SLAB // width):
                unit = chosen[at : at + SLAB // width]
                real = np.arange(width) < number[unit][:, None]
                pair = np.where(real, first[unit][:, None] + np.arange(width), 0)
                near = np.where(real, other[pair], len(words) - 1)
                weight = np.where(real, times[pair], 0).astype(np.float32) * alpha
                centre = owner[unit]
                deep = int(size[centre].max())
                on = path[:deep, centre].T
                x, y = words[near], nodes[on]
                out = y @ x.transpose(0, 2, 1)
                np.negative(out, out=out)
                np.exp(out, out=out)
                out += 1
                np.divide(-1, out, out=out)
                out += target[:deep, centre].T[:, :, None]
                out *= weight[:, None, :]
                weight /= 4
                bend = np.einsum("nld,nld->n", y, y)[:, None] * weight
                to_words.append((near.ravel(), (out.transpose(0, 2, 1) @ y).reshape(-1, words.shape[1]), bend.ravel()))
                bend = (np.einsum("ncd,ncd->nc", x, x) * weight).sum(axis=1)
                to_nodes.append((on.ravel(), (out @ x).reshape(-1, words.shape[1]), np.repeat(bend, deep)))
        add_to(words, word_slot, to_words)
        add_to(nodes, node_slot, to_nodes)


def train(
    texts: list[np.ndarray], key: np.ndarray, lengths: dict[int, int], words: np.ndarray, known: dict[int, np.ndarray],
    seed: int, epoch: int = 0, epochs: int = 1,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and vectors of a shard's words, then keys, pairs and vectors of its nodes.

    ``texts`` hold places in ``key``, the ascending ranks of the words; ``words`` and ``known`` are the vectors to go on from.
    """
    dim = words.shape[1]
    code, size = codes(key, lengths)
    node_key, path, target = paths(code, size)
    words = np.concatenate([words, np.zeros((1, dim), np.float32)])
    nodes = np.zeros((len(node_key) + 1, dim), np.float32)
    for i, k in enumerate(node_key.tolist() if known else ()):
        nodes[i] = known.get(k, 0)
    counts = np.array([len(t) for t in texts], np.int64)
    ids = np.concatenate(texts) if texts else np.zeros(0, np.int32)
    within = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
    sentence = np.cumsum(within % SENTENCE == 0)
    # Segments end where a sentence does, so no pair is torn apart.
    ends = np.append(np.flatnonzero(within % SENTENCE == 0), len(ids))
    cuts = np.unique(np.append(ends[np.searchsorted(ends, np.arange(0, len(ids), SEGMENT))], len(ids))).tolist()
    n_words, n_nodes = np.zeros(len(words), np.int64), np.zeros(len(nodes), np.int64)
    rng = np.random.default_rng([seed % (1 << 32), epoch])
    with np.errstate(over="ignore"):
        for at, stop in zip(cuts[:-1], cuts[1:], strict=True):
            word, other, times = pair_counts(ids[at:stop], sentence[at:stop], len(key), rng)
            if not len(word) or not len(node_key):
                continue
            n_words += np.bincount(other, times, len(words)).astype(np.int64)
            used = np.bincount(word, times, len(key))
            for level in path:
                n_nodes += np.bincount(level, used, len(nodes)).astype(np.int64)

            def rate(share: float, at: int = at, stop: int = stop) -> float:
                done = (at + share * (stop - at)) / len(ids)
                return max(LEAST_RATE, RATE * (1 - (epoch + done) / epochs))

            train_counts(word, other, times, size, path, target, words, nodes, rate, rng)
    return n_words[:-1], words[:-1], node_key, n_nodes[:-1], nodes[:-1]


def _lists(values: pa.Array, counts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows, np.float32)
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * (4 * rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows)])


def _rows(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    found = [np.frombuffer(b"".join(c.to_pylist()), np.float32).reshape(-1, dim) for c in chunks]
    return np.concatenate(found) if found else np.zeros((0, dim), np.float32)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, tokens -> per text its tokens as places in the shard's words, and one row with these words and their numbers."""
    shard = TaskContext.get().partitionId() << 24

    def block(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens, names = rows.column(1), ["shard", "at", "id", "codes", "words", "counts"]
        counts = tokens.value_lengths().fill_null(0).to_numpy()
        coded = tokens.flatten().dictionary_encode()
        each, n = _lists(coded.indices, counts), rows.num_rows
        empty = [pa.nulls(n, pa.list_(pa.string())), pa.nulls(n, pa.list_(pa.int64()))]
        where = [pa.array(np.full(n, shard)), pa.array(np.arange(n))]
        yield pa.RecordBatch.from_arrays([*where, rows.column(0), each, *empty], names)
        times = np.bincount(coded.indices.to_numpy(), minlength=len(coded.dictionary))
        found = [_lists(v, np.array([len(times)])) for v in (coded.dictionary, pa.array(times, pa.int64()))]
        none = [pa.nulls(1, pa.int64()), pa.nulls(1, rows.schema.field(0).type), pa.nulls(1, each.type)]
        yield pa.RecordBatch.from_arrays([pa.array([shard]), *none, *found], names)

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SHARD_TOKENS - size, side="right")))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1]) - before
            at = stop
            if size >= SHARD_TOKENS or at < batch.num_rows:
                yield from block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size, shard = [], 0, shard + 1
    if held:
        yield from block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _texts(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """A shard's texts in their order, their lengths and all their codes."""
    rows = rows.sort_by("at").combine_chunks()
    held = rows.column("codes").combine_chunks()
    held = pa.concat_arrays(held.chunks) if isinstance(held, pa.ChunkedArray) else held
    return rows, held.value_lengths().to_numpy(), held.flatten().to_numpy()


def _trained(lengths: dict[int, int], dim: int, seed: int, epoch: int, epochs: int) -> Callable:
    def task(texts: pa.Table, state: pa.Table) -> pa.Table:
        """A shard's texts and the vectors so far -> its vectors, with the number of pairs behind each."""
        empty = pa.Table.from_pylist([], pa.schema([("shard", pa.int64()), ("local", pa.int32()), ("key", pa.int64()), ("n", pa.int64()), ("vec", pa.binary())]))
        if not state.num_rows or not texts.num_rows:
            return empty
        _, counts, flat = _texts(texts)
        state = state.sort_by("key").combine_chunks()
        of_word = state.column("key").to_numpy() >= 0
        nodes, named = state.filter(pa.array(~of_word)), state.filter(pa.array(of_word))
        key, local = named.column("key").to_numpy(), named.column("local").to_numpy()
        words = _rows(named.column("vec"), dim) if epoch else start(key, dim, seed)
        known = dict(zip((-nodes.column("key").to_numpy()).tolist(), _rows(nodes.column("vec"), dim), strict=True)) if epoch else {}
        place = np.full(max(int(local.max()), int(flat.max(initial=0))) + 1, -1, np.int32)
        place[local] = np.arange(len(key))
        flat = place[flat]
        lines = [t[t >= 0] for t in np.split(flat, np.cumsum(counts)[:-1])]
        shard = texts.column("shard")[0].as_py()
        n, vec, node_key, node_n, node_vec = train(lines, key, lengths, words, known, seed ^ shard, epoch, epochs)
        if epoch == epochs - 1:
            node_key, node_n, node_vec = node_key[:0], node_n[:0], node_vec[:0]
        local = np.concatenate([local, np.full(len(node_key), -1, np.int32)])
        keys, n = np.concatenate([key, -node_key]), np.concatenate([n, node_n])
        return pa.table([pa.array(np.full(len(keys), shard)), pa.array(local, pa.int32()), pa.array(keys), pa.array(n), _bytes(np.concatenate([vec, node_vec]))], schema=empty.schema)

    return task


def _merged(dim: int) -> Callable:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All shards' vectors of some words and nodes -> the same rows with their weighted mean; without pairs, the first vector."""
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by([("key", "ascending"), ("shard", "ascending")]).combine_chunks()
        key, n, vec = rows.column("key").to_numpy(), rows.column("n").to_numpy(), _rows(rows.column("vec"), dim)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        of = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
        total = np.bincount(of, n)
        mean = np.empty((len(first), dim), np.float32)
        for j in range(dim):
            mean[:, j] = np.bincount(of, vec[:, j] * n.astype(float)) / np.maximum(total, 1)
        mean[total == 0] = vec[first[total == 0]]
        for at in range(0, len(key), SLAB):
            part = of[at : at + SLAB]
            columns = [rows.column(c).combine_chunks().slice(at, len(part)) for c in ("shard", "local", "key", "n")]
            yield pa.RecordBatch.from_arrays([*columns, _bytes(mean[part])], ["shard", "local", "key", "n", "vec"])

    return task


def _means(dim: int, row_id: str) -> Callable:
    def task(texts: pa.Table, state: pa.Table) -> pa.Table:
        """A shard's texts and the vectors of its words -> the sum of a text's vectors by its number of words, known or not."""
        rows, counts, flat = _texts(texts)
        local = state.column("local").to_numpy()
        vectors = np.zeros((max(int(local.max(initial=0)), int(flat.max(initial=0))) + 1, dim), np.float32)
        vectors[local] = _rows(state.column("vec"), dim)
        mean = np.zeros((len(counts), dim), np.float32)
        at = np.concatenate([[0], np.cumsum(counts)])
        for i in np.flatnonzero(counts):
            mean[i] = vectors[flat[at[i] : at[i + 1]]].sum(axis=0, dtype=np.float64) / counts[i]
        values = _lists(pa.array(mean.ravel()), np.full(len(counts), dim))
        return pa.table([rows.column("id").combine_chunks(), values], names=[row_id, "embedding"])

    return task


def mean_vectors(
    docs: DataFrame, row_id: str, tokens: Column, *, dim: int, seed: int, min_count: int, partitions: int, max_iter: int
) -> DataFrame:
    """``(row_id, embedding)``: per text the mean of its words' vectors, trained on all texts in at least ``partitions`` shards."""
    kind = docs.schema[row_id].dataType.simpleString()
    rows = docs.repartition(partitions).select(F.col(row_id).alias("id"), tokens.alias("tokens"))
    coded = stored(
        rows.mapInArrow(_coded, f"shard long, at long, id {kind}, codes array<int>, words array<string>, counts array<long>"), "word-codes"
    )
    texts = coded.where(F.col("words").isNull()).select("shard", "at", "id", "codes")
    named = coded.where(F.col("words").isNotNull())
    entries = named.select("shard", F.posexplode(F.arrays_zip("words", "counts")).alias("local", "e")).select(
        "shard", "local", F.col("e.words").alias("word"), F.col("e.counts").alias("n")
    )
    vocabulary = stored(entries.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "words")
    counts = {r.n: r.words for r in vocabulary.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()}
    if not counts:
        raise ValueError(f"no word occurs {min_count} times")
    lengths = code_lengths(counts)
    ranked = global_rank(vocabulary, [F.col("n").desc(), F.col("word")], out="key").select("word", "key")
    state = stored(
        entries.drop("n").join(ranked, "word").select(
            "shard", F.col("local").cast("int"), "key", F.lit(0).cast("long").alias("n"), F.lit(None).cast("binary").alias("vec")
        ),
        "word-keys",
    )
    # More parts than shards, as shards meet by hash; the parts of a given number are not joined again.
    parts = 4 * named.count()
    by_shard = texts.repartition(parts, "shard").groupBy("shard")
    for epoch in range(max_iter):
        met = by_shard.cogroup(state.repartition(parts, "shard").groupBy("shard"))
        trained = met.applyInArrow(_trained(lengths, dim, seed, epoch, max_iter), STATE)
        state = stored(trained.repartition(parts, "key").mapInArrow(_merged(dim), STATE), "word-vectors")
    met = by_shard.cogroup(state.where(F.col("local") >= 0).repartition(parts, "shard").groupBy("shard"))
    return met.applyInArrow(_means(dim, row_id), f"`{row_id}` {kind}, embedding array<float>")
