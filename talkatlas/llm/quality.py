"""Quality scores: ridge on random Fourier features of document statistics, calibrated by isotonic regression.

Every whole text becomes a fixed vector of statistics: shares of byte classes, shapes and repetition of
words and lines. Random Fourier features approximate a Gaussian kernel over the standardised
statistics. Each task sums the normal equations of its labelled rows, one sum per fold; the model is the ridge
solution of the total, and leaving one fold's sum out gives scores of rows that a model has not seen. Their
averages per score bin are calibrated by pooling adjacent violators, and new scores are read off by
linear interpolation.

Rows are learned from if their label is 0 or 1 and crc32 of the id as text is no multiple of ``HELD_OUT``; of more
than ``FIT_ROWS`` such rows a hash of the id picks about that many (the only bound; every row is
scored). Rows with a NULL id are held out. NULL and empty texts have zero statistics and a score like any
other. Without a labelled row every score is 0.5. Repeated rows have equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm import texts
from talkatlas.llm.tables import kept

HELD_OUT = 5
FIT_ROWS = 200_000
FIT_PARTS = 8
FOLDS = 5
FEATURES = 300
RIDGES = (1e-4, 1e-3, 1e-2, 1e-1)  # per training row
BINS = 1000
THRESHOLD = 0.3
SEED = 20_240

CLASSES = 14
_CLASS = np.full(256, CLASSES - 1, dtype=np.int64)
for _n, _bytes in enumerate(
    (
        range(97, 123), range(65, 91), range(48, 58), b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!?", b"|", b"'\"-:;()",
        b"#$%&*+/<=>@[\\]^_`{}~", range(0x80, 0x100),
    )
):
    _CLASS[list(_bytes)] = _n
_ENDS_PLAIN = np.zeros(256, dtype=bool)
_ENDS_PLAIN[[*range(97, 123), *range(65, 91), *range(48, 58), *b".,", *range(0x80, 0x100)]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True


def _different(row: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different keys of each row, and the count of its commonest one."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    opens = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (row[1:] != row[:-1])]))
    most = np.zeros(n)
    np.maximum.at(most, row[opens], np.diff(np.append(opens, len(keys))))
    return np.bincount(row[opens], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics per text of a block."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    shares = np.bincount(owner * CLASSES + _CLASS[data], minlength=n * CLASSES).reshape(n, CLASSES)
    shares = shares / np.maximum(size, 1)[:, None]
    words = texts.find_words(data, offsets)
    row, hashes = words.row_of_word(), texts.word_hash(words)
    count = np.diff(words.first).astype(float)
    some = np.maximum(count, 1)
    length = (words.end - words.start).astype(float)
    mean = np.bincount(row, length, n) / some
    spread = np.sqrt(np.maximum(np.bincount(row, length**2, n) / some - mean**2, 0))
    different, most = _different(row, hashes, n)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    pair = texts.mix(hashes[pairs] * np.uint64(3) + hashes[pairs + 1])
    pair_different, _ = _different(row[pairs], pair, n)
    last = data[words.end - 1] if len(words.end) else data[:0]
    heads = data[words.start] if len(words.start) else data[:0]
    second = data[np.minimum(words.start + 1, words.end - 1)] if len(words.start) else data[:0]
    per_word = [
        np.bincount(row, flag, n) / some
        for flag in (~_ENDS_PLAIN[last], _UPPER[heads] & _UPPER[second], _UPPER[heads] & _LOWER[second], length == 1, length > 15)
    ]
    feed = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([offsets[:-1][size > 0], feed + 1]))  # a text may end with a line feed
    start = start[start < len(data)]
    line_row = np.searchsorted(offsets, start, side="right") - 1
    end = np.minimum(np.append(start[1:], len(data)), offsets[line_row + 1])
    lines = np.bincount(line_row, minlength=n).astype(float)
    line_hash = np.zeros(len(start), np.uint64)
    for at in range(0, len(start), 4096):
        low = start[at]
        stop = min(len(start), at + 4096)
        line_hash[at:stop] = texts.spans_hash(data[low : end[stop - 1]], start[at:stop] - low, end[at:stop] - low)
    line_different, line_most = _different(line_row, line_hash, n)
    at_least = np.maximum(lines, 1)
    columns = [
        np.log1p(size), np.log1p(count), mean, np.log1p(mean), spread, different / some, most / some,
        pair_different / np.maximum(count - 1, 1), np.log1p(lines), np.log1p(size / at_least),
        line_different / at_least, line_most / at_least, *per_word,
    ]
    return np.concatenate([shares, np.stack(columns, axis=1)], axis=1)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics(data, offsets) for _, _, data, offsets in texts.blocks(batch.column(1))]
        if found:
            stats = np.concatenate(found).astype(np.float32)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(stats.ravel()), stats.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), lists.cast(pa.list_(pa.float32()))], ["doc_id", "stats"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every row; one pass over the texts, nothing shuffled."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_measure, "doc_id long, stats array<float>")


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, 1))
    return column.flatten().to_numpy().astype(float).reshape(len(column), -1)


@dataclass(frozen=True)
class Fourier:
    """Random Fourier features of standardised statistics, and a constant."""

    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phase: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        cosines = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.waves + self.phase)
        return np.concatenate([cosines, np.ones((len(z), 1))], axis=1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        x = _matrix(batch.column("stats"))
        if len(x):
            part = np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)])
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])


def _normal_equations(fourier: Fourier):
    """Per task and fold: the sums of z z', z y, y y and 1 over its rows, as one flat vector."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            z, y = fourier(_matrix(batch.column("stats"))), batch.column("label").to_numpy().astype(float)
            folds = batch.column("fold").to_numpy()
            for fold in np.unique(folds):
                own = folds == fold
                zy = np.concatenate([z[own], y[own, None]], axis=1)
                total[int(fold)] = total.get(int(fold), 0) + zy.T @ zy
        for fold, part in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([fold], pa.int32()), pa.array([part.astype("<f8").tobytes()])], ["fold", "sums"]
            )

    return sums


@dataclass(frozen=True)
class Model:
    fourier: Fourier
    weights: np.ndarray
    held: np.ndarray  # weights without one fold, by fold
    knots: np.ndarray
    values: np.ndarray

    def raw(self, stats: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats, self.weights), self.knots, self.values), 0.0, 1.0)


def _solve(sums: np.ndarray, n: float, ridge: float) -> np.ndarray:
    a, b = sums[:-1, :-1], sums[:-1, -1]
    penalty = ridge * max(n, 1.0) * np.eye(len(a))
    penalty[-1, -1] = 1e-9  # the constant goes free
    return np.linalg.solve(a + penalty, b)


def ridge_by_fold(sums: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights on all folds, and on all but one, with the penalty of the least error on unseen folds."""
    total = sum(sums.values())
    best = None
    for ridge in RIDGES:
        held, error = [], 0.0
        for fold in range(FOLDS):
            own = sums.get(fold, np.zeros_like(total))
            rest = total - own
            w = _solve(rest, rest[-2, -2], ridge)
            error += w @ own[:-1, :-1] @ w - 2 * w @ own[:-1, -1] + own[-1, -1]
            held.append(w)
        if best is None or error < best[0]:
            best = error, ridge, np.stack(held)
    return _solve(total, total[-2, -2], best[1]), best[2]


def isotonic(x: np.ndarray, mean: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising step function that fits ``mean`` at ``x`` best (pool adjacent violators)."""
    pools: list[list[float]] = []
    for at, value, w in sorted(zip(x, mean, weight, strict=True)):
        pools.append([at * w, value * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    found = np.array(pools)
    return found[:, 0] / found[:, 2], found[:, 1] / found[:, 2]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the row is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(True))


def _training_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    rows = stats.where(~held_out()).join(own.where("label IN (0, 1)"), "doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = kept(rows.select("doc_id", "stats", "label", fold.alias("fold")), "labelled")
    n = rows.count()
    if n > FIT_ROWS:
        share = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
        rows = rows.where(share < FIT_ROWS * 1_000_000 // n)
    return rows


def fit(stats: DataFrame, labels: DataFrame) -> Model | None:
    """The calibrated model, or None without a labelled row."""
    rows = kept(_training_rows(stats, labels), "training").coalesce(FIT_PARTS)  # few sums for the driver to add
    moments = [np.array(r.sums) for r in rows.mapInArrow(_moments, "sums array<double>").collect()]
    if not moments:
        return None
    total = sum(moments)
    mean, square = np.split(total[1:] / total[0], 2)
    scale = np.sqrt(np.maximum(square - mean**2, 0))
    scale[scale < 1e-6] = 1.0
    rng = np.random.default_rng(SEED)
    waves = rng.normal(size=(len(mean), FEATURES)) / np.sqrt(len(mean))
    fourier = Fourier(mean, scale, waves, rng.uniform(0, 2 * np.pi, FEATURES))
    sums: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(_normal_equations(fourier), "fold int, sums binary").collect():
        part = np.frombuffer(r.sums, "<f8").reshape(FEATURES + 2, FEATURES + 2)
        sums[r.fold] = sums.get(r.fold, 0) + part
    weights, held = ridge_by_fold(sums)
    model = Model(fourier, weights, held, np.zeros(1), np.zeros(1))

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, fold = model.fourier(_matrix(batch.column("stats"))), batch.column("fold").to_numpy()
            raw = np.einsum("ij,ij->i", z, model.held[fold])
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("label")], ["raw", "label"])

    bin_of = F.floor(F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "raw")) * BINS)
    bins = (
        rows.mapInArrow(unseen, "raw double, label int")
        .groupBy(bin_of.alias("bin"))
        .agg(F.avg("raw").alias("raw"), F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n"))
        .collect()  # 3 * BINS + 1 rows at most
    )
    knots, values = isotonic(*(np.array([r[k] for r in bins], float) for k in ("raw", "mean", "n")))
    return Model(fourier, weights, held, knots, values)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    stats = kept(document_statistics(docs), "statistics")
    model = fit(stats, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return stats.mapInArrow(scored, "doc_id long, score double").select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are not rejected; rows with a NULL id stay."""
    rejected = quality_scores(docs, labels).where("predicted = 0").select("doc_id").distinct()
    return docs.join(kept(rejected, "rejected"), "doc_id", "left_anti")
