"""Packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

A document's tokens (closed by an end token) are one piece; only a longer document than a sequence is cut,
into full pieces and a rest. Full pieces fill a sequence each. The others are dealt into shards of
about ``SHARD_PIECES`` pieces. On every shard several islands evolve packings:

* a packing is a set of bins; the first ones come from best fit on perturbed decreasing orders;
* crossover injects whole well-filled bins of one parent into the other, removes the bins that held one
  of the injected pieces, and puts the displaced pieces back by best fit; mutation empties the worst bins;
* after each epoch the best packing of an island migrates to the next island of the shard through a shuffle.

An island stops when its packing needs no more bins than the lower bound. The bins of the best island that
are not well filled are dissolved, and their pieces meet the leftovers of other shards in the next
tier, until one shard is left or a tier no longer shrinks. No task holds more than one shard.

A NULL or empty text is its end token alone. Ids are carried, never compared: NULL, repeated and clashing
ids are pieces of their own rows. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkatlas.llm import texts
from talkatlas.llm.tables import kept

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 8192
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
WELL_FILLED = 0.995
CACHE_WORDS = 1 << 19
JOINED_WORDS = 512
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(48, 58), *range(97, 123)]] = True


class WordTokens:
    """Token ids of the words of a text whose tokenizer drops white space and lower-cases.

    Its splits never cross white space, so a text's ids are those of its words in turn. Different words are
    encoded once per worker and found again by hash.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)  # sorted word hashes, and where their ids are in the store
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.store = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[list[int]]:
        """Ids of words that are one split each: encoded as one text, cut where a token closes a word."""
        out: list[list[int]] = []
        for at in range(0, len(words), JOINED_WORDS):
            part = words[at : at + JOINED_WORDS]
            ids = np.array(self._encode([" ".join(part)])[0], np.int64)
            ends = np.flatnonzero(self.closes[ids]) + 1
            out += [x.tolist() for x in np.split(ids, ends[:-1])] if len(ends) == len(part) else self._encode(part)
        return out

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain = [unicodedata.normalize("NFC", w).lower().isalpha() for w in words]
        joined = iter(self._joined([w for w, p in zip(words, plain, strict=True) if p]))
        single = iter(self._encode([w for w, p in zip(words, plain, strict=True) if not p]))
        ids = [next(joined) if p else next(single) for p in plain]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        start = len(self.store) + np.cumsum(size) - size
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))
        self.store = np.concatenate([self.store, flat])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known = known[order]
        self.start = np.concatenate([self.start, start])[order]
        self.size = np.concatenate([self.size, size])[order]

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the offsets of the rows."""
        words, hashes = _split(data, offsets)
        if len(self.known) > CACHE_WORDS:
            self.clear()
        different, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        spot = np.minimum(np.searchsorted(self.known, different), max(0, len(self.known) - 1))
        new = self.known[spot] != different if len(self.known) else np.ones(len(different), bool)
        if new.any():
            body = words.data.tobytes()
            self.learn(
                different[new],
                [body[s:e].decode("utf-8", "replace") for s, e in zip(words.start[at[new]], words.end[at[new]], strict=True)],
            )
            spot = np.searchsorted(self.known, different)
        size = self.size[spot][which] if len(different) else np.zeros(0, np.int64)
        begin = self.start[spot][which] if len(different) else size
        ends = np.cumsum(size)
        ids = self.store[np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))]
        return ids, np.concatenate([[0], ends])[words.first]


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[texts.Words, np.ndarray]:
    """Words with ASCII letters in lower case; a last comma or full stop after a letter or digit is its own word.

    Words that may hold a special token keep their case.
    """
    low = _LOWER[data]
    words = texts.find_words(low, offsets)
    special = np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))
    for i in np.unique(np.searchsorted(words.start, special, side="right") - 1):
        low[words.start[i] : words.end[i]] = data[words.start[i] : words.end[i]]
    last = words.end - 1
    stop = (low[last] == ord(".")) | (low[last] == ord(","))
    stop &= (words.end - words.start > 1) & _ALNUM[low[np.maximum(last - 1, 0)]]
    cut = np.flatnonzero(stop)
    start = np.insert(words.start, cut + 1, last[cut])
    end = np.insert(words.end, cut, last[cut])
    words = texts.Words(low, start, end, np.searchsorted(start, offsets, side="left"))
    return words, texts.word_hash(words)


def _pieces(path: str, capacity: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(path)
        for batch in batches:
            for lo, hi, data, offsets in texts.blocks(batch.column(1)):
                ids, first = tokens.rows(data, offsets)
                body, out = ids.astype("<u4"), []
                close = np.array([END_ID], "<u4").tobytes()
                for row in range(hi - lo):
                    own = body[first[row] : first[row + 1]].tobytes() + close
                    for piece, at in enumerate(range(0, len(own), 4 * capacity)):
                        part = own[at : at + 4 * capacity]
                        out.append((lo + row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                row, piece, start, length, crc = (np.array(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row)),
                        pa.array(piece, pa.int32()),
                        *(pa.array(c, pa.int64()) for c in (start, length, crc)),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return pieces


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of all documents."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _pieces(tokenizer, capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


class Bins:
    """Open bins by the room they have left; finds the fullest bin that still takes a piece."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        self.count = 0

    def add(self, number: int, room: int) -> None:
        self.by_room[room].append(number)
        self.mask |= 1 << room

    def put(self, length: int) -> int:
        rest = self.mask >> length
        if rest:
            room = length + (rest & -rest).bit_length() - 1
            held = self.by_room[room]
            number = held.pop()
            if not held:
                self.mask &= ~(1 << room)
        else:
            number, room = self.count, self.capacity
            self.count += 1
        self.add(number, room - length)
        return number


def best_fit(length: np.ndarray, order: np.ndarray, capacity: int, bins: Bins | None = None) -> np.ndarray:
    """Bin of every piece of ``order``, packed in that order."""
    bins = bins or Bins(capacity)
    return np.fromiter((bins.put(x) for x in length[order].tolist()), np.int64, len(order))


def crossover(a: np.ndarray, b: np.ndarray, length: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``a`` with some of the best-filled bins of ``b`` injected whole."""
    fill_a, fill_b = (np.bincount(x, weights=length) for x in (a, b))
    good = np.flatnonzero(fill_b >= max(WELL_FILLED * capacity, np.quantile(fill_b, 0.5)))
    inject = np.zeros(len(fill_b), bool)
    inject[good[rng.random(len(good)) < 0.5]] = True
    injected = inject[b]
    broken = np.zeros(len(fill_a), bool)
    broken[a[injected]] = True
    broken[np.argsort(fill_a)[: 1 + len(fill_a) // 50]] = True  # mutation: the worst bins
    return _rebuild(a, b, length, capacity, injected, broken)


def _rebuild(a, b, length, capacity, injected, broken) -> np.ndarray:
    stays = ~broken[a] & ~injected
    displaced = np.flatnonzero(broken[a] & ~injected)
    child = np.full(len(length), -1, np.int64)
    child[stays] = np.unique(a[stays], return_inverse=True)[1]
    n = int(child.max()) + 1
    child[injected] = n + np.unique(b[injected], return_inverse=True)[1] if injected.any() else 0
    bins = Bins(capacity)
    bins.count = int(child.max()) + 1
    placed = child >= 0
    room = capacity - np.bincount(child[placed], weights=length[placed], minlength=bins.count).astype(np.int64)
    for number in np.flatnonzero(room).tolist():
        bins.add(number, int(room[number]))
    order = displaced[np.argsort(-length[displaced], kind="stable")]
    child[order] = best_fit(length, order, capacity, bins)
    return np.unique(child, return_inverse=True)[1]


def score(solution: np.ndarray, length: np.ndarray) -> tuple[int, float]:
    """Fewer bins first, then the larger sum of squared fills: smaller is better."""
    fill = np.bincount(solution, weights=length)
    return len(fill), -float((fill**2).sum())


def evolve(
    length: np.ndarray, own: list[np.ndarray], capacity: int, seed: int, generations: int, population: int
) -> np.ndarray:
    """The best packing after some generations, from the packings given and fresh ones."""
    rng = np.random.default_rng(seed)
    least = max(-(-int(length.sum()) // capacity), int((length > capacity / 2).sum()))
    people = list(own)
    if not people:
        people.append(best_fit_decreasing(length, capacity, rng, 0.0))
    best = min(people, key=lambda x: score(x, length))
    for _ in range(generations if score(best, length)[0] > least else 0):
        while len(people) < population:
            people.append(best_fit_decreasing(length, capacity, rng, 0.2))
        i, j = rng.choice(len(people), 2, replace=False)
        people.append(crossover(people[i], people[j], length, capacity, rng))
        people.append(crossover(people[j], people[i], length, capacity, rng))
        people = sorted(people, key=lambda x: score(x, length))[:population]
        best = people[0]
        if score(best, length)[0] <= least:
            break
    return best


def best_fit_decreasing(length: np.ndarray, capacity: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    key = length * (1 + noise * rng.random(len(length)))
    order = np.argsort(-key, kind="stable")
    out = np.empty(len(length), np.int64)
    out[order] = best_fit(length, order, capacity)
    return out


def _epoch(capacity: int, islands: int, number: int, generations: int, population: int):
    def epoch(rows: pd.DataFrame) -> pd.DataFrame:
        """One island: every piece with the island's own bin and, from the second epoch, a migrant's."""
        rows = rows.sort_values(["role", "mid"], kind="stable")
        shard, island = int(rows.shard.iloc[0]), int(rows.island.iloc[0])
        roles = [part for _, part in rows.groupby("role", sort=True)]
        pieces = roles[0]
        length = pieces.length.to_numpy()
        packings = [np.unique(p.bin.to_numpy(), return_inverse=True)[1] for p in roles if (p.bin >= 0).all()]
        seed = (shard * 1009 + island) * 31 + number
        best = evolve(length, packings, capacity, seed, generations, population)
        n_bins, squares = score(best, length)
        out = pieces.assign(bin=best, n_bins=n_bins, squares=squares, role=0)
        if islands > 1:
            out = pd.concat([out, out.assign(island=(island + 1) % islands, role=1)])
        return out[["shard", "island", "role", "mid", "length", "bin", "n_bins", "squares"]]

    return epoch


def _tier(pieces: DataFrame, n: int, tier: int, capacity: int, shard_pieces: int, islands: int) -> DataFrame:
    """``mid, length, sequence_id, fill`` for pieces ``mid, length`` that are shorter than a sequence."""
    shards = max(1, -(-n // shard_pieces))
    state = pieces.select(
        F.pmod(F.xxhash64("mid", F.lit(tier)), F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.array([F.lit(i) for i in range(islands)])).alias("island"),
        F.lit(0).alias("role"),
        "mid",
        "length",
        F.lit(-1).cast("long").alias("bin"),
    )
    schema = "shard int, island int, role int, mid long, length long, bin long, n_bins long, squares double"
    for number in range(EPOCHS):
        state = (
            state.repartition("shard", "island")
            .groupBy("shard", "island")
            .applyInPandas(_epoch(capacity, islands, number, GENERATIONS, POPULATION), schema)
        )
    state = kept(state.where("role = 0"), f"tier-{tier}")
    best = state.groupBy("shard").agg(F.min(F.struct("n_bins", "squares", "island")).alias("best"))
    chosen = state.join(best.select("shard", F.col("best.island").alias("island")), ["shard", "island"])
    sequence = (F.col("shard").cast("long") * (1 << 24) + F.col("bin") + (tier << 52)).alias("sequence_id")
    chosen = chosen.select("mid", "length", sequence)
    fill = chosen.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    return kept(chosen.join(fill, "sequence_id"), f"packed-{tier}")


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES, islands: int = ISLANDS
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; needs a column ``length`` between 1 and ``capacity``."""
    rows = kept(pieces.withColumn("mid", F.monotonically_increasing_id()), "pieces")
    rest = rows.where(F.col("length") < capacity).select("mid", "length")
    n, tier, done = rest.count(), 0, []
    while n:
        packed = _tier(rest, n, tier, capacity, shard_pieces, islands)
        loose = packed.where(F.col("fill") < WELL_FILLED * capacity)
        m = loose.count() if n > shard_pieces else 0
        if not 0 < m < n:
            done.append(packed)
            break
        done.append(packed.where(F.col("fill") >= WELL_FILLED * capacity))
        rest, n, tier = loose.select("mid", "length"), m, tier + 1
    full = rows.select("mid", (-1 - F.col("mid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "length")
    places = full.where(F.col("length") >= capacity).drop("length")
    before = Window.partitionBy("sequence_id").orderBy("mid").rowsBetween(Window.unboundedPreceding, -1)
    for packed in done:
        offset = F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset")
        places = places.unionByName(packed.select("mid", "sequence_id", offset))
    return rows.join(places, "mid").drop("mid")


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it."""
    return pack(token_pieces(docs, tokenizer, capacity), capacity)
