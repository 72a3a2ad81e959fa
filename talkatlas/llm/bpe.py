"""Byte-pair encoding and decoding by batched numpy merge rounds.

The symbols of many different words lie in one flat array. In each round the rank of every pair of
neighbours is found by binary search over the sorted pair keys of the merge table, every word's
lowest-ranked pair is replaced wherever it stands in the word, and words without a known pair drop out. A round
costs a few array operations for all words together; the number of rounds is that of the longest merge
sequence, so words are dealt by length.

Splitting, special tokens and bytes follow the tokenizer file: byte-level pre-tokenisation, no
normaliser. Texts are split before the search for words, so special tokens in a text have their ids. NULL
texts are empty: no ids, empty decoded text. Rows are encoded on their own; repeated rows get equal ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how the byte-level pre-tokeniser splits a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_WORDS = 400_000
BATCH_WORDS = 20_000
BATCH_CHARS = 1 << 22
NO_RANK = np.int64(1) << 40


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, by letter."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        letters = byte_letters()
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.of_byte = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.of_byte[b] = vocabulary[letter]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in spec["model"]["merges"]]
        key = np.array([(vocabulary[a] << 20) | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.pair, self.rank = key[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        self.special = special
        self.split = regex.compile(SPLIT)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.known: dict[str, bytes] = {}

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 20) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.rank[at], NO_RANK)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of every word (not empty)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        symbol = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), size)
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        while len(symbol):
            rank = np.full(len(symbol), NO_RANK)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inner] = self._ranks(symbol[inner], symbol[inner + 1])
            start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(rank, start)
            size = np.diff(np.append(start, len(symbol)))
            done = least == NO_RANK
            for w in np.flatnonzero(done).tolist():
                out[owner[start[w]]] = symbol[start[w] : start[w] + size[w]]
            least = np.repeat(least, size)
            hit = (rank == least) & (least < NO_RANK)
            # Of overlapping pairs (equal symbols in a row) every second one merges, from the left.
            spots = np.flatnonzero(hit)
            run_start = np.concatenate([[True], spots[1:] != spots[:-1] + 1]) if len(spots) else np.zeros(0, bool)
            first = spots[np.flatnonzero(run_start)][np.cumsum(run_start) - 1] if len(spots) else spots
            spots = spots[(spots - first) % 2 == 0]
            symbol = symbol.copy()
            symbol[spots] = self.merged[rank[spots]]
            stays = np.repeat(~done, size)
            stays[spots + 1] = False
            symbol, owner = symbol[stays], owner[stays]
        return out

    def _learn(self, words: list[str]) -> None:
        """Encode new words, in batches of words of like length."""
        coded = sorted(((w.encode("utf-8"), w) for w in words), key=lambda x: len(x[0]))
        for at in range(0, len(coded), BATCH_WORDS):
            part = coded[at : at + BATCH_WORDS]
            for (_, word), ids in zip(part, self.merge([b for b, _ in part]), strict=True):
                self.known[word] = ids.astype("<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        split: list[list[str | int]] = []
        for text in texts:
            words: list[str | int] = []
            for n, part in enumerate(self.special_split.split(text) if self.special else [text]):
                if n % 2:
                    words.append(self.special[part])
                elif part:
                    words += self.split.findall(part)
            split.append(words)
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        new = {w for words in split for w in words if isinstance(w, str) and w not in known}
        if new:
            self._learn(list(new))
        return [
            b"".join([known[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in words]) for words in split
        ]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _coded(path: str, with_ids: bool):
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            lo = 0
            while lo < len(texts):
                hi, size = lo + 1, len(texts[lo])
                while hi < len(texts) and size + len(texts[hi]) <= BATCH_CHARS:
                    size += len(texts[hi])
                    hi += 1
                ids = bpe.encode(texts[lo:hi])
                decoded = [bpe.decode(np.frombuffer(x, "<u4")) for x in ids]
                columns = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(decoded)]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)
                lo = hi

    return coded


def encoded(docs: DataFrame, tokenizer: str, with_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, if wanted, ``ids`` and ``decoded`` of every row."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_coded(tokenizer, with_ids), schema + (", ids array<int>, decoded string" if with_ids else ""))
