"""Language by compression: the dictionary that makes a text smallest names its language.

For every learned language some labelled texts form a raw-content zstandard dictionary. A text, reduced
to its letters in lower case, is compressed, in blocks of ``BLOCK`` bytes so that all of a long text is judged by the dictionaries and not by its
own earlier part, once with every dictionary; the language with the smallest sum of sizes wins. The share saved
against the second best is the margin; a prediction with a narrow margin is marked as rejected.

Learned from are rows with a text, a language and a crc32 of the id as text that leaves no 2 modulo
``FOLDS``; of each language about ``FIT_TEXTS`` of them, chosen by a hash of the id (the only bound). Their whole texts count:
a dictionary is every different word of them, the most frequent last, where a reference to it is shortest. The window of the
compressor is as wide as the dictionary. Every text is scored whole. Rows with a NULL id are held out.
A NULL text and a text without a letter are ``und`` with score 0, and so is every text if nothing was
learned. Ties go to the language that sorts first. Repeated rows get equal answers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
HELD_OUT = 2
FIT_TEXTS = 1600
BLOCK = 2048
LEVEL = 6
MIN_WINDOW_LOG = 12
NARROW = 0.01
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The words of a text in lower case, with one blank for everything between them."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode()


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(True))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(language, word, count) of the whole texts of a batch."""
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.update((lang, word) for word in letters(text).split())
        langs, words = list(zip(*counts, strict=True)) or [(), ()]
        columns = [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """Raw dictionary content of every language: all words of hashed texts, by ascending count and word."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    million = F.lit(1_000_000)
    share = F.element_at(
        F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, FIT_TEXTS * 1_000_000 // n + 1)]), F.col("lang")
    )
    counted = (
        rows.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), million) < share)
        .select("lang", "text")
        .mapInArrow(_word_counts, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .collect()  # the vocabulary of about FIT_TEXTS texts a language
    )
    words: dict[str, list[tuple[int, bytes]]] = {}
    for r in counted:
        words.setdefault(r.lang, []).append((r.n, bytes(r.word)))
    return {lang: b" ".join(word for _, word in sorted(found)) for lang, found in sorted(words.items())}


class Judge:
    """Compressed sizes of a text with the dictionary of every language."""

    def __init__(self, content: dict[str, bytes]):
        self.names = list(content)
        self.compressors = []
        for body in content.values():
            held = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            span = (len(body) + BLOCK).bit_length()
            wide = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, dict_size=len(body), window_log=max(MIN_WINDOW_LOG, span), write_content_size=False, write_checksum=False, write_dict_id=False
            )
            held.precompute_compress(compression_params=wide)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=held, compression_params=wide))

    def sizes(self, text: bytes) -> np.ndarray:
        blocks = [text[at : at + BLOCK] for at in range(0, len(text), BLOCK)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self.compressors], np.int64)

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """Language, score between 0 and 1, margin over the second best."""
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0
        size = self.sizes(letters(text))
        best = int(size.argmin())
        rest = np.delete(size, best)
        margin = float(1 - size[best] / rest.min()) if len(rest) else 1.0
        return self.names[best], min(1.0, 0.5 + 5 * margin), margin


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, margin, rejected`` of every row."""
    content = dictionaries(docs)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(content)
        for batch in batches:
            found = [judge(text) for text in batch.column(1).to_pylist()]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(columns[0], pa.string()), *(pa.array(c, pa.float64()) for c in columns[1:])],
                ["doc_id", "lang_pred", "score", "margin"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(judged, "doc_id long, lang_pred string, score double, margin double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "margin", (F.col("margin") < NARROW).alias("rejected")
    )
