"""Removal of repeated windows, found by doubling their length level by level.

A *window* of ``PASSAGE`` neighbouring words is repeated if a document with a smaller id holds the same words. Every word that a
repeated window covers is removed; windows are judged on the input, not on what is left.

1. Of the windows of a level of L words only those count that content selects: of the ``L + 1`` windows of L words inside a
   window of 2 L words the one with the least hash. Equal windows of 2 L words select equal windows of L words. The
   levels are half a passage, a passage, two passages and so on, up to half a document's length; all are found in one pass.
2. A window is *shared* if it stands in two documents. The windows of the first level are counted; those shared alone are extended
   to twice that length: a candidate of the next level is a window whose selected half is shared. The candidates
   are counted in turn, and so on until no candidates survive. A shared window of a passage or more that an earlier
   document holds is *settled*: so does that document hold every window inside it.
3. Removal needs every window of a passage, not only selected ones. The documents that hold a shared window of the first level come
   with their texts, each window of a passage whose selected half is shared and that lies in no settled window gives one
   row, and the least document id of every window is found. That id's own row is always there: a window inside a settled one
   stands in a still earlier document. A window that more than ``GROUP_ROWS`` rows may hold is dealt to
   several groups first, and the least ids of the groups are aggregated.
4. The settled windows and those that stand in an earlier document are cut out of the texts that hold them.

Exact copies of a text are one text in steps 2 and 3, and a copy of at least one window goes whole. Words are maximal runs of
anything but ASCII white space, unchanged, and windows are compared by 64-bit hashes. A NULL text has no words. A row
with a NULL id stays as it is and no other row is judged by it. Rows that repeat an id and a text get the same result; different
texts under one id are not judged by each other. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm import texts
from talkatlas.llm.tables import kept

PASSAGE = 50
GROUP_ROWS = 20_000
KEY = ["doc_id", "digest"]
SKETCH = (
    "doc_id long, digest long, n_words long, whole string, halves array<long>,"
    " longer array<struct<words: int, window: long, half: long>>"
)


def _windows(hashes: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words over the block; 0 where a window crosses two documents."""
    at = np.arange(max(0, len(hashes) - size + 1))
    found = texts.spans_hash(hashes, at, at + size) | np.uint64(1)
    found[row[at] != row[at + size - 1]] = 0
    return found


def _least(windows: np.ndarray, size: int) -> np.ndarray:
    """The selected window of ``size`` words in every window of ``2 * size`` words; 0 where that crosses two documents."""
    return texts.sliding_min(windows, size + 1) if len(windows) > size else np.zeros(0, np.uint64)


def _chosen(windows: np.ndarray, least: np.ndarray, size: int) -> np.ndarray:
    """Places of the windows that are selected in some window of twice their length."""
    if not len(least):
        return np.zeros(0, np.int64)
    none = np.zeros(size, np.uint64)
    greatest = ~texts.sliding_min(~np.concatenate([none, least, none]), size + 1)
    # ``greatest[i]`` is the largest of the selected hashes around place i; it equals the window's own if it is selected.
    return np.flatnonzero((greatest == windows) & (windows != 0))


def _lists(values: pa.Array, owner: np.ndarray, rows: int) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=rows))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _sketch(passage: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, digest, text -> number of words, digest of all words, selected windows of every level."""
        for batch in batches:
            for lo, hi, data, offsets in texts.blocks(batch.column(2)):
                words = texts.find_words(data, offsets)
                hashes, row = texts.word_hash(words), words.row_of_word()
                counts = np.diff(words.first)
                size, half = passage // 2, None
                halves = None
                found: list[tuple[np.ndarray, ...]] = []
                while 2 * size <= counts.max(initial=0):
                    windows = _windows(hashes, row, size)
                    least = _least(windows, size)
                    at = _chosen(windows, least, size)
                    if halves is None:
                        once = np.sort(np.unique(_row_keys(row[at], windows[at]), return_index=True)[1])
                        halves = row[at[once]], windows[at[once]]
                    else:
                        found.append((row[at], np.full(len(at), size), windows[at], half[at]))
                    size, half = 2 * size, least
                none = np.zeros(0, np.int64), np.zeros(0, np.uint64)
                owner, window = halves or none
                parts = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [none[0], none[0], none[1], none[1]]
                by = np.argsort(parts[0], kind="stable")
                longer = pa.StructArray.from_arrays(
                    [pa.array(parts[1][by], pa.int32()), *(pa.array(c[by].view(np.int64)) for c in parts[2:])],
                    ["words", "window", "half"],
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        pa.array(counts, pa.int64()),
                        pa.array([_kept_sha256(words, r, None) for r in range(hi - lo)], pa.string()),
                        _lists(pa.array(window.view(np.int64)), owner, hi - lo),
                        _lists(longer, parts[0], hi - lo),
                    ],
                    ["doc_id", "digest", "n_words", "whole", "halves", "longer"],
                )

    return task


def _kept_sha256(words: texts.Words, row: int, stays: np.ndarray | None) -> str:
    """Digest of the words of a row that stay, joined by one space."""
    mine = slice(words.first[row], words.first[row + 1])
    start, end = words.start[mine], words.end[mine]
    if stays is not None:
        start, end = start[stays], end[stays]
    digest = hashlib.sha256()
    if len(start):
        body = words.data[start[0] : end[-1]]
        # One space before each word but the first; what stands between the words that stay goes.
        inside = np.zeros(len(body) + 1, np.int8)
        inside[start - start[0]] += 1
        inside[end - start[0]] -= 1
        held = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        held[start[1:] - start[0] - 1] = True
        body = body.copy()
        body[start[1:] - start[0] - 1] = 0x20
        digest.update(body[held].tobytes())
    return digest.hexdigest()


def _row_keys(rows: np.ndarray, values: np.ndarray) -> np.ndarray:
    """One 64-bit key for a row of the block and a hash of that row."""
    return texts.mix(texts.mix(rows.astype(np.uint64) + np.uint64(1)) ^ values)


def _starts(hashes: np.ndarray, row: np.ndarray, listed: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """Sizes and places of the windows that are listed for their row as (words, window)."""
    owner = np.repeat(np.arange(len(listed)), listed.value_lengths().fill_null(0).to_numpy())
    sizes, wanted = (listed.flatten().field(k).to_numpy() for k in range(2))
    keys = _row_keys(owner, wanted.view(np.uint64))
    for size in np.unique(sizes).tolist():
        windows = _windows(hashes, row, size)
        at = np.flatnonzero(windows)
        yield size, at[np.isin(_row_keys(row[at], windows[at]), keys[sizes == size])]


def _under(n: int, spans: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """Which of ``n`` places the spans (length, starts) cover."""
    edge = np.zeros(n + 1, np.int64)
    for length, at in spans:
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _passages(passage: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, digest, text, shared halves with their groups, settled windows -> the windows to judge, once per document."""
        for batch in batches:
            ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offsets in texts.blocks(batch.column(2)):
                words = texts.find_words(data, offsets)
                hashes, row = texts.word_hash(words), words.row_of_word()
                least = _least(_windows(hashes, row, passage // 2), passage // 2)
                whole = _windows(hashes, row, passage)
                spots = batch.column(3).slice(lo, hi - lo)
                owner = np.repeat(np.arange(hi - lo), spots.value_lengths().to_numpy())
                shared = _row_keys(owner, spots.flatten().field(0).to_numpy().view(np.uint64))
                groups = spots.flatten().field(1).to_numpy()
                by = np.argsort(shared)
                shared, groups = shared[by], groups[by]
                settled = _starts(hashes, row, batch.column(4).slice(lo, hi - lo))
                inside = _under(len(hashes), ((size - passage + 1, at) for size, at in settled))
                at = np.flatnonzero((whole != 0) & ~inside[: len(whole)])
                mine = _row_keys(row[at], least[at])
                place = np.minimum(np.searchsorted(shared, mine), max(0, len(shared) - 1))
                hit = shared[place] == mine if len(shared) else np.zeros(len(at), bool)
                at, place = at[hit], place[hit]
                once = np.unique(_row_keys(row[at], whole[at]), return_index=True)[1]
                at, place = at[once], place[once]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo + row[at]], pa.int64()),
                        pa.array(digests[lo + row[at]], pa.int64()),
                        pa.array(whole[at].view(np.int64)),
                        pa.array(groups[place], pa.int32()),
                    ],
                    ["doc_id", "digest", "window", "groups"],
                )

    return task


def _covered(words: texts.Words, listed: pa.Array) -> np.ndarray:
    """Words of the block that a listed window of their row covers."""
    hashes = texts.word_hash(words)
    return _under(len(hashes), _starts(hashes, words.row_of_word(), listed))


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, digest, text, repeated windows -> doc_id, digest, n_removed, kept_sha256."""
    for batch in batches:
        for lo, hi, data, offsets in texts.blocks(batch.column(2)):
            words = texts.find_words(data, offsets)
            gone = _covered(words, batch.column(3).slice(lo, hi - lo))
            total = np.concatenate([[0], np.cumsum(gone)])
            first = words.first
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(1).slice(lo, hi - lo),
                    pa.array(total[first[1:]] - total[first[:-1]], pa.int64()),
                    pa.array([_kept_sha256(words, r, ~gone[first[r] : first[r + 1]]) for r in range(hi - lo)], pa.string()),
                ],
                ["doc_id", "digest", "n_removed", "kept_sha256"],
            )


def _cut(text: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their repeated windows in the last column -> the rows with the words that stay, joined by one space."""
        for batch in batches:
            out, listed = [], batch.column(batch.num_columns - 1)
            for n, value in enumerate(batch.column(text)):
                one = value.as_py()
                if one is not None and listed[n].is_valid:
                    data = np.frombuffer(one.encode(), np.uint8)
                    words = texts.find_words(data, np.array([0, len(data)]))
                    gone = _covered(words, listed.slice(n, 1))
                    stays = zip(words.start[~gone].tolist(), words.end[~gone].tolist(), strict=True)
                    one = b" ".join(data[a:b].tobytes() for a, b in stays).decode()
                out.append(one)
            left = batch.select(range(batch.num_columns - 1))
            yield left.set_column(text, batch.schema.field(text), pa.array(out, batch.schema.field(text).type))

    return task


def _digest(text: Column) -> Column:
    return F.xxhash64(F.sha2(F.coalesce(text, F.lit("")), 256))


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        _digest(F.col(text)).alias("digest"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )


class Repeats:
    """Windows of ``passage`` words (an even number) of ``docs`` that an earlier document holds.

    ``sketch`` has a row per row of ``docs``; ``first`` one per different text, its digest and least id.
    """

    def __init__(
        self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE, group_rows: int = GROUP_ROWS
    ) -> None:
        self.rows, self.passage, self.group_rows = _texts(docs, doc_id, text), passage, group_rows
        self.sketch = kept(self.rows.mapInArrow(_sketch(passage), SKETCH), "sketch")
        owned = self.sketch.where("doc_id IS NOT NULL")
        self.first = kept(owned.groupBy("digest").agg(F.min("doc_id").alias("doc_id")), "first")
        # Digest and id together, so that a text with very many copies is no hot key.
        self.different = owned.join(self.first, KEY, "left_semi").dropDuplicates(KEY)

    def shared(self) -> DataFrame:
        """``window, n, least``: windows of half a passage that stand in two documents at least, their rows and least id."""
        halves = self.sketch.where("doc_id IS NOT NULL").select(*KEY, F.explode("halves").alias("window"))
        return kept(_in_two(halves.groupBy("window")), "shared")

    def settled(self, shared: DataFrame, spots: DataFrame) -> DataFrame:
        """``doc_id, digest, words, window``: selected windows of a passage and more that an earlier document holds.

        Only the documents of ``spots`` can hold one: those that share a window of the first level.
        """
        longer = self.sketch.join(spots, KEY, "left_semi").dropDuplicates(KEY).select(*KEY, F.explode("longer").alias("s"))
        spots = kept(longer.select(*KEY, "s.*"), "levels")
        found = spots.where("false").select(*KEY, "words", "window")
        size = self.passage
        while True:
            extended = shared.select(F.col("window").alias("half"))
            candidates = spots.where(F.col("words") == size).join(extended, "half", "left_semi")
            shared = kept(_in_two(candidates.groupBy("window")), "shared")
            if shared.isEmpty():
                return found
            later = candidates.join(shared, "window").where("least < doc_id").select(*KEY, "words", "window")
            found = found.unionByName(later)
            size *= 2

    def sharing(self, shared: DataFrame) -> DataFrame:
        """Texts that hold a shared window of half a passage; with these, the groups they are dealt to, and settled windows."""
        groups = F.ceil(F.col("n") / F.lit(self.group_rows)).cast("int")
        spots = (
            self.different.select(*KEY, F.explode("halves").alias("window"))
            .join(shared.select("window", groups.alias("groups")), "window")
            .groupBy(*KEY)
            .agg(F.collect_list(F.struct("window", "groups")).alias("spots"))
        )
        spots = kept(spots, "spots")
        settled = self.settled(shared, spots).groupBy(*KEY).agg(F.collect_list(F.struct("words", "window")).alias("settled"))
        found = self.rows.where("doc_id IS NOT NULL").join(spots.join(settled, KEY, "left").hint("shuffle_hash"), KEY)
        return kept(found.select(*KEY, "text", "spots", F.coalesce("settled", F.array()).alias("settled")), "sharing")

    def repeated(self, sharing: DataFrame) -> DataFrame:
        """``doc_id, digest, windows``: windows (words, window) of the document that stand in one with a smaller id."""
        window = sharing.mapInArrow(_passages(self.passage), "doc_id long, digest long, window long, groups int")
        dealt = window.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("groups")).cast("int"))
        least = F.expr("min(doc_id) OVER (PARTITION BY window, part)")
        judged = dealt.withColumn("least", least).where("least < doc_id OR groups > 1")
        judged = kept(judged.select(*KEY, "window", "least"), "judged")
        # The least of each group of a dealt window is judged by the least of all groups.
        heads = judged.where("least = doc_id")
        over_all = heads.groupBy("window").agg(F.min("doc_id").alias("over_all"))
        later = heads.join(over_all, "window").where("over_all < doc_id").select(*KEY, "window")
        found = judged.where("least < doc_id").select(*KEY, "window").unionByName(later)
        return found.groupBy(*KEY).agg(
            F.collect_list(F.struct(F.lit(self.passage).alias("words"), "window")).alias("windows")
        )

    def removed(self) -> DataFrame:
        """``doc_id, digest, text, windows``: documents that lose words, with all their repeated windows."""
        sharing = self.sharing(self.shared())
        found = sharing.join(self.repeated(sharing).hint("shuffle_hash"), KEY, "left")
        every = F.concat("settled", F.coalesce("windows", F.array())).alias("windows")
        return found.select(*KEY, "text", every).where(F.size("windows") > 0)


def _in_two(grouped) -> DataFrame:
    """Windows that stand in two texts of different documents at least, with the number of their rows and the least id."""
    found = grouped.agg(
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("_most"),
        F.min("digest").alias("_low"),
        F.max("digest").alias("_high"),
        F.count(F.lit(1)).alias("n"),
    )
    return found.where("least < _most AND _low < _high").select("window", "n", "least")


def removals(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs``.

    ``kept_sha256`` is the digest of the words that stay, joined by one space.
    """
    found = Repeats(docs, doc_id, text, passage, group_rows)
    changed = found.removed().mapInArrow(_removal, "doc_id long, digest long, n_removed long, kept_sha256 string")
    changed = kept(changed.dropDuplicates(KEY), "changed")
    result = (
        found.sketch.select(*KEY, "n_words", "whole")
        .join(found.first.withColumn("is_first", F.lit(True)), KEY, "left")
        .join(changed, KEY, "left")
    )
    copy = F.col("doc_id").isNotNull() & F.col("is_first").isNull() & (F.col("n_words") >= passage)
    return result.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
    )


def without_repeated_windows(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", passage: int = PASSAGE, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """``docs`` without the repeated words of ``text``.

    A text that loses words is the words that stay, joined by one space; other texts come back byte for byte.
    """
    found = Repeats(docs, doc_id, text, passage, group_rows)
    windows = kept(found.removed().drop("text").dropDuplicates(KEY), "windows")
    windows = windows.toDF("_id", "_digest", "_windows")
    first = found.first.select(F.col("doc_id").alias("_first_id"), F.col("digest").alias("_first"))
    own_id, own_digest = F.col(doc_id).cast("long"), _digest(F.col(text))
    joined = docs.join(first, (own_id == F.col("_first_id")) & (own_digest == F.col("_first")), "left").join(
        windows.hint("shuffle_hash"), (own_id == F.col("_id")) & (own_digest == F.col("_digest")), "left"
    )
    n_words = F.size(F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    copy = own_id.isNotNull() & F.col("_first").isNull() & (n_words >= passage)
    bare = joined.withColumn(text, F.when(copy, F.lit("")).otherwise(F.col(text))).select(*docs.columns, "_windows")
    return bare.mapInArrow(_cut(docs.columns.index(text)), bare.drop("_windows").schema)
