from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from corpus import frame, odd_texts, words
from tokenizers import Tokenizer

from talkatlas.llm import packing
from talkatlas.llm.registry import WORD_BPE

PATH = public_tokenizers.path(WORD_BPE)


def check(rows, capacity):
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_match_the_library(spark):
    rng = random.Random(1)
    texts = odd_texts(rng) + [
        (50, "It's DON'T foo,bar. x... ***. Ǻ क़ İstanbul ΣΑΣ.  ﬁ 1,234.5 é è"),
        (51, ", . ,. <| <|endoftext|>, a<|startoftext|>b THE<|endoftext|>"),
        *[(60 + k, " ".join(words(rng, 900, "abcdeé'.,ñÉ1"))) for k in range(6)],
    ]
    rows = packing.packed_documents(frame(spark, texts), PATH).collect()
    lib = Tokenizer.from_file(PATH)
    want = []
    for i, t in texts:
        ids = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((str(i), k, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    check(rows, 2048)


@pytest.mark.parametrize("shard", [40, 8192])
def test_packing_is_whole_and_close_to_the_bound(spark, shard):
    rng = random.Random(9)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(1, 45), rng.randint(30, 60), 100]) for _ in range(700)]
    pieces = spark.createDataFrame([(k % 300, n) for k, n in enumerate(sizes)], "doc_id long, length long")
    rows = packing.pack(pieces, 100, shard).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == sorted((k % 300, n) for k, n in enumerate(sizes))
    assert check(rows, 100) <= -(-sum(sizes) // 100) * 1.02 + 1


def test_crossover_keeps_every_piece_once_and_no_bin_overflows():
    rng = np.random.default_rng(4)
    for _ in range(50):
        length = rng.integers(1, 100, rng.integers(1, 80))
        a, b = (packing.best_fit_decreasing(length, 100, rng, 0.5) for _ in range(2))
        child = packing.crossover(a, b, length, 100, rng)
        assert len(child) == len(length) and np.bincount(child, weights=length).max() <= 100
        assert set(child) == set(range(child.max() + 1))


def test_generations_never_lose_to_best_fit():
    rng = np.random.default_rng(8)
    better = 0
    for seed in range(15):
        length = rng.integers(20, 70, 120)
        plain = packing.best_fit_decreasing(length, 100, rng, 0.0)
        best = packing.evolve(length, [plain], 100, seed, 30, 6)
        assert packing.score(best, length) <= packing.score(plain, length)
        better += packing.score(best, length)[0] < packing.score(plain, length)[0]
    assert better > 0


def test_empty_table(spark):
    assert packing.packed_documents(frame(spark, [(1, "a")]).limit(0), PATH).count() == 0
