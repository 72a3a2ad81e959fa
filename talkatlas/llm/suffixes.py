"""Repeated passages by sparse suffix arrays.

A *window* is ``PASSAGE`` neighbouring words of one document. A window is repeated if the same words
stand at an earlier place, where places are ordered by (doc_id, word position). The repeated windows of
a document are merged into spans; removing the spans leaves the first copy of every passage.

1. Suffixes are kept only at content-selected places: of every ``PASSAGE - GRAM + 1`` neighbouring word
   grams, the one with the least hash. Equal windows select equal places, so no repeat is lost, and about
   one place in 18 is kept.
2. Suffixes whose first gram occurs once in the corpus are dropped by a count.
3. The rest meet by their gram, are sorted by the words that follow, neighbours are compared, and within
   each run of suffixes that agree far enough to the right the match is extended to the left.

Exact copies of a text are one text in these steps (the copy with the smallest id); the other copies
are one span each. Places of a document with the same gram and context are one suffix with a list of places, so a line that a
document repeats is compared once. A gram that more than ``GROUP_ROWS`` suffixes start with is not sorted in one
task: there every window is a row of its own, and the least place of each window's hash is found by an aggregation.
Both ways give the same spans and the same first documents.

Words are separated by ASCII white space and compared by 64-bit (gram) and 32-bit (word) hashes, so
two different windows count as equal with a chance below 2**-32. NULL and short texts have no window.
Rows with a NULL id take no part. Repeated rows of one document (same id and text) are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkatlas.llm import texts
from talkatlas.llm.tables import kept

PASSAGE = 50
GRAM = 16
REACH = PASSAGE - GRAM  # words of context on either side that windows around a place can cover
GROUP_ROWS = 50_000  # suffixes of one gram in one task, some 15 MB of context
FLAT_ROWS = 20_000


def _places(words: texts.Words) -> tuple[np.ndarray, np.ndarray]:
    """Word positions (over the block) of the selected suffixes and the hashes of their first grams."""
    hashes = texts.word_hash(words)
    n = len(hashes) - GRAM + 1
    width = REACH + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    grams = texts.spans_hash(hashes, at, at + GRAM) | np.uint64(1)
    least = texts.sliding_min(grams, width)
    row = words.row_of_word()
    least[row[: len(least)] != row[PASSAGE - 1 :]] = 0  # windows across two documents select nothing
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(~texts.sliding_min(~padded, width) == grams)
    return chosen, grams[chosen]


def _ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, digest, text -> doc_id, digest, number of words, grams and places of the suffixes."""
    for batch in batches:
        for lo, hi, data, offsets in texts.blocks(batch.column(2)):
            words = texts.find_words(data, offsets)
            chosen, grams = _places(words)
            owner = np.searchsorted(words.first, chosen, side="right") - 1
            counts = np.bincount(owner, minlength=hi - lo)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(lo, hi - lo),
                    batch.column(1).slice(lo, hi - lo),
                    pa.array(np.diff(words.first), pa.int64()),
                    _ragged(grams.view(np.int64), counts, pa.int64()),
                    _ragged((chosen - words.first[owner]).astype(np.int32), counts, pa.int32()),
                ],
                ["doc_id", "digest", "n_words", "gram", "place"],
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words around the places of each document: REACH to the left, nearest first, and REACH after the gram.

    Words are 32-bit hashes over 0; 0 stands for no word. ``place`` is the first place of a document with this gram and
    context, ``more`` are the others.
    """
    step = np.arange(REACH)
    for batch in batches:
        ids, digests = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, hi, data, offsets in texts.blocks(batch.column(2)):
            words = texts.find_words(data, offsets)
            hashes = (texts.word_hash(words) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            hashes = np.append(hashes, np.uint32(0))
            none = len(hashes) - 1
            holds = batch.column(3).slice(lo, hi - lo)
            spots = holds.flatten()
            owner = np.repeat(np.arange(hi - lo), holds.value_lengths().to_numpy())
            for low, high in _runs(owner):
                row, part = owner[low:high], spots.slice(low, high - low)
                place, gram = part.field(0).to_numpy().astype(np.int64), part.field(1).to_numpy()
                at = (place + words.first[row])[:, None]
                left, right = at - 1 - step, at + GRAM + step
                left = np.where(left >= words.first[row][:, None], left, none)
                right = np.where(right < words.first[row + 1][:, None], right, none)
                around = hashes[np.concatenate([left, right], axis=1)].astype(">u4")
                order, opens = _same(row, gram, around)
                lead, counts = order[opens], np.diff(np.append(opens, len(order))) - 1
                rest = np.delete(order, opens)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[lo + row[lead]], pa.int64()),
                        pa.array(digests[lo + row[lead]], pa.int64()),
                        pa.array(place[lead], pa.int32()),
                        _ragged(place[rest].astype(np.int32), counts, pa.int32()),
                        pa.array(gram[lead], pa.int64()),
                        pa.FixedSizeBinaryArray.from_buffers(
                            pa.binary(8 * REACH), len(lead), [None, pa.py_buffer(around[lead].tobytes())]
                        ).cast(pa.binary()),
                    ],
                    [c.split()[0] for c in CONTEXT.split(", ")],
                )


def _runs(owner: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about FLAT_ROWS entries; a document is split only if it alone has more."""
    at = 0
    while at < len(owner):
        stop = min(len(owner), at + FLAT_ROWS)
        if stop < len(owner):
            whole = int(np.searchsorted(owner, owner[stop], side="left"))
            stop = whole if whole > at else stop
        yield at, stop
        at = stop


def _same(row: np.ndarray, gram: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal suffixes of a document follow one another by place, and where each of them opens."""
    flat = np.ascontiguousarray(around).view(np.dtype((np.void, 8 * REACH))).ravel()
    context = np.unique(flat, return_inverse=True)[1].ravel()
    order = np.lexsort((np.arange(len(row)), context, gram, row))
    key = np.stack([row[order], gram[order], context[order]])
    return order, np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))


def match(group: np.ndarray, around: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Equal windows of suffixes that are given in the order of their places.

    ``group`` numbers the suffixes' grams, ``around`` holds the contexts. Yields, for every number of words
    to the left of the place: the rows that have such a window, and for each the first row with an equal window.
    """
    n = len(group)
    left, right = around[:, :REACH], around[:, REACH:]
    # The suffix array: suffixes of a gram sorted by the words that follow, and what neighbours share.
    key = np.ascontiguousarray(right.astype(">u4")).view(f"S{4 * REACH}").ravel()
    order = np.lexsort((np.unique(key, return_inverse=True)[1], group))
    agree = right[order[1:]] == right[order[:-1]]
    shared = np.where(agree.all(axis=1), REACH, agree.argmin(axis=1))
    shared[group[order[1:]] != group[order[:-1]]] = -1
    n_left, n_right = (left != 0).sum(axis=1), (right != 0).sum(axis=1)
    leftward = np.zeros(n, np.uint64)
    run = np.empty(n, np.uint64)
    for back in range(REACH + 1):
        if back:
            leftward = texts.mix(leftward + left[:, back - 1].astype(np.uint64) + np.uint64(1))
        ahead = REACH - back
        run[order] = np.concatenate([[0], np.cumsum(shared < ahead)])
        rows = np.flatnonzero((n_left >= back) & (n_right >= ahead))
        if len(rows):
            window = texts.mix(run[rows] + np.uint64(1)) ^ leftward[rows]
            by = np.argsort(window, kind="stable")
            opens = np.flatnonzero(np.concatenate([[True], window[by[1:]] != window[by[:-1]]]))
            first = np.empty(len(rows), np.int64)
            first[by] = np.repeat(rows[by[opens]], np.diff(np.append(opens, len(by))))
            yield back, rows, first


def _complete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by gram, re-cut so that no group is split; groups are of bounded size."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < FLAT_ROWS:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        gram = rows.column("gram").to_numpy()
        change = np.flatnonzero(gram[1:] != gram[:-1])
        if len(change):
            cut = int(change[-1]) + 1
            yield rows.slice(0, cut)
            rows = rows.slice(cut)
        held, size = rows.to_batches(), rows.num_rows
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _around(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return texts.raw(column)[0].view(">u4").reshape(-1, 2 * REACH).astype(np.uint32)


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats among the suffixes of each gram as (document, starts, mask, first_doc); bit i of the mask is the window at start + i."""
    for rows in _complete(batches):
        order = np.lexsort((rows.column("place").to_numpy(), rows.column("doc_id").to_numpy()))
        rows = rows.take(pa.array(order)).combine_chunks()
        group = np.unique(rows.column("gram").to_numpy(), return_inverse=True)[1]
        doc, digest = rows.column("doc_id").to_numpy(), rows.column("digest").to_numpy()
        place = rows.column("place").to_numpy().astype(np.int64)
        every, mask = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        source, earliest = np.full((2, len(doc)), LONG_MAX)
        for back, here, first in match(group, _around(rows.column("around"))):
            bit = np.int64(1) << np.int64(REACH - back)
            every[here] |= bit
            source[here] = np.minimum(source[here], doc[first])
            later = here != first
            again = here[later]
            mask[again] |= bit
            earliest[again] = np.minimum(earliest[again], doc[first[later]])
        hit = np.flatnonzero(mask)
        one = np.ones(len(hit), np.int64)
        yield _found(doc[hit], digest[hit], _ragged((place[hit] - REACH).astype(np.int32), one, pa.int32()), mask[hit], earliest[hit])
        # The other places of a suffix repeat each of its windows.
        more = rows.column("more").combine_chunks()
        counts = more.value_lengths().to_numpy()
        on = np.flatnonzero((counts > 0) & (every != 0))
        starts = more.take(pa.array(on))
        starts = _ragged(starts.flatten().to_numpy() - REACH, counts[on], pa.int32())
        yield _found(doc[on], digest[on], starts, every[on], source[on])


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every suffix as (window, doc_id, digest, start, more); ``more`` are its other starts in the document."""
    for batch in batches:
        doc, digest = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        place, gram = batch.column(2).to_numpy(), batch.column(4).to_numpy().view(np.uint64)
        around = _around(batch.column(5))
        n_left, n_right = ((side != 0).sum(axis=1) for side in (around[:, :REACH], around[:, REACH:]))
        for back in range(REACH + 1):
            rows = np.flatnonzero((n_left >= back) & (n_right >= REACH - back))
            more = batch.column(3).take(pa.array(rows))
            counts = more.value_lengths().to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_window_hash(gram[rows], around[rows], back).view(np.int64)),
                    pa.array(doc[rows], pa.int64()),
                    pa.array(digest[rows], pa.int64()),
                    pa.array(place[rows] - np.int32(back), pa.int32()),
                    _ragged(more.flatten().to_numpy() - np.int32(back), counts, pa.int32()),
                ],
                ["window", "doc_id", "digest", "start", "more"],
            )


def _window_hash(gram: np.ndarray, around: np.ndarray, back: int) -> np.ndarray:
    """Hash of the windows with ``back`` words before the place; ``gram`` stands for the gram itself."""
    found = texts.mix(gram + np.uint64(back + 1))
    for column in [*range(back), *range(REACH, 2 * REACH - back)]:
        found = texts.mix(found + around[:, column].astype(np.uint64) + np.uint64(1))
    return found


CONTEXT = "doc_id long, digest long, place int, more array<int>, gram long, around binary"
FOUND = "doc_id long, digest long, starts array<int>, mask long, first_doc long"
LONG_MAX = np.iinfo(np.int64).max


def _found(doc, digest, starts: pa.Array, mask, first_doc) -> pa.RecordBatch:
    columns = [pa.array(doc, pa.int64()), pa.array(digest, pa.int64()), starts, pa.array(mask, pa.int64()), pa.array(first_doc, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in FOUND.split(", ")])


def _by_windows(contexts: DataFrame) -> DataFrame:
    """What :func:`_matches` finds, for grams of any number of suffixes: window by window."""
    windows = kept(contexts.mapInArrow(_single, "window long, doc_id long, digest long, start int, more array<int>"), "windows")
    place = F.struct("doc_id", "start")
    repeated = (F.count(F.lit(1)) > 1) | F.max(F.size("more") > 0)
    first = windows.groupBy("window").agg(F.min(place).alias("first"), repeated.alias("repeated")).where("repeated")
    later = F.when(place != F.col("first"), F.array("start")).otherwise(F.array().cast("array<int>"))
    return (
        windows.join(kept(first, "first-windows"), "window")
        .select("doc_id", "digest", F.concat(later, "more").alias("starts"), F.lit(1).cast("long").alias("mask"), F.col("first.doc_id").alias("first_doc"))
        .where(F.size("starts") > 0)
    )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of each document -> its spans: words [start_word, start_word + n_words) and the least first_doc."""
    offset = np.arange(REACH + 1)
    for batch in batches:
        owner, spans = [], []
        for row, found in enumerate(batch.column(2)):
            listed, mask, first_doc = (found.values.field(k) for k in range(3))
            counts = listed.value_lengths().to_numpy()
            start = listed.flatten().to_numpy()
            mask, first_doc = (np.repeat(c.to_numpy(), counts) for c in (mask, first_doc))
            rows, bit = np.nonzero((mask[:, None] >> offset) & 1)
            begin = start[rows].astype(np.int64) + bit
            order = np.argsort(begin, kind="stable")
            begin, source = begin[order], first_doc[rows][order]
            opens = np.flatnonzero(np.concatenate([[True], begin[1:] > begin[:-1] + PASSAGE]))
            last = np.append(opens[1:], len(begin)) - 1
            owner += [row] * len(opens)
            spans.append((begin[opens], begin[last] + PASSAGE - begin[opens], np.minimum.reduceat(source, opens)))
        if owner:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(owner)),
                    batch.column(1).take(pa.array(owner)),
                    *(pa.array(np.concatenate(v), pa.int64()) for v in zip(*spans, strict=True)),
                ],
                ["doc_id", "digest", "start_word", "n_words", "first_doc_id"],
            )


def _digest(text: str) -> Column:
    return F.xxhash64(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, start_word, n_words, first_doc_id``: the repeated spans of every document.

    ``first_doc_id`` is the smallest id of a document that holds a window of the span earlier; it is the document
    itself if only that repeats the passage, and for an exact copy the first copy. ``digest`` tells texts with one id apart.
    """
    rows = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"),
        _digest(text).alias("digest"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    sketch = kept(
        rows.mapInArrow(_sketch, "doc_id long, digest long, n_words long, gram array<long>, place array<int>"), "sketch"
    )
    first = kept(sketch.groupBy("digest").agg(F.min("doc_id").alias("first_doc")), "first")
    of_first = sketch.join(first, [sketch.digest == first.digest, sketch.doc_id == first.first_doc], "left_semi")
    suffixes = kept(
        of_first.dropDuplicates(["doc_id", "digest"])
        .select("doc_id", "digest", F.explode(F.arrays_zip("gram", "place")).alias("s"))
        .select("doc_id", "digest", "s.gram", "s.place"),
        "suffixes",
    )
    shared = kept(suffixes.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    wanted = (
        suffixes.join(shared, "gram")
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("spots"))
    )
    around = rows.join(wanted.hint("shuffle_hash"), ["doc_id", "digest"])
    contexts = kept(around.select("doc_id", "digest", "text", "spots").mapInArrow(_contexts, CONTEXT), "contexts")
    sizes = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    crowded = kept(sizes.where(F.col("n") > GROUP_ROWS).select("gram"), "crowded")
    met = contexts.join(crowded, "gram", "left_anti").select(*contexts.columns)
    found = met.repartition("gram").sortWithinPartitions("gram").mapInArrow(_matches, FOUND)
    across = contexts.join(crowded, "gram", "left_semi").select(*contexts.columns)
    spans = (
        found.unionByName(_by_windows(across))
        .groupBy("doc_id", "digest")
        .agg(F.collect_list(F.struct("starts", "mask", "first_doc")).alias("found"))
        .mapInArrow(_merge, "doc_id long, digest long, start_word long, n_words long, first_doc_id long")
    )
    copies = (
        sketch.where(F.col("n_words") >= PASSAGE)
        .join(first, "digest")
        .where("doc_id <> first_doc")
        .select("doc_id", "digest", F.lit(0).cast("long").alias("start_word"), "n_words", F.col("first_doc").alias("first_doc_id"))
        .distinct()
    )
    return spans.unionByName(copies)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
            if text and spans:
                data = np.frombuffer(text.encode(), np.uint8)
                words = texts.find_words(data, np.array([0, len(data)]))
                at, left = 0, []
                for start, size in sorted((s["start_word"], s["n_words"]) for s in spans):
                    left.append(data[at : words.start[start]])
                    stop = start + size
                    at = words.start[stop] if stop < len(words.start) else len(data)
                text = np.concatenate([*left, data[at:]]).tobytes().decode()
            out.append(text)
        yield batch.drop_columns(["_spans"]).set_column(
            batch.schema.get_field_index("text"), "text", pa.array(out, pa.string())
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text``; ``n_chars`` follows the text that is left.

    A text without spans comes back byte for byte. A text that is one long repeat becomes empty; a
    NULL text stays NULL with NULL ``n_chars``.
    """
    spans = repeated_spans(docs).groupBy("doc_id", "digest").agg(
        F.collect_list(F.struct("start_word", "n_words")).alias("_spans")
    )
    spans = kept(spans, "spans").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "_spans")
    mine = (F.col("doc_id") == F.col("_id")) & (_digest("text") == F.col("_digest"))
    joined = docs.join(spans.hint("shuffle_hash"), mine, "left").select(*docs.columns, "_spans")
    cut = joined.mapInArrow(_cut, joined.drop("_spans").schema)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
