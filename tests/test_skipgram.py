from __future__ import annotations

import heapq

import numpy as np
import pytest

from talkatlas.operators import embed as E
from talkatlas.operators import skipgram as S


def huffman_cost(counts):
    heap, cost = sorted(counts), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


def grouped(counts):
    return {int(c): int(n) for c, n in zip(*np.unique(counts, return_counts=True), strict=True)}


@pytest.mark.parametrize("seed", range(6))
def test_codes_are_a_huffman_code(seed):
    rng = np.random.default_rng(seed)
    counts = -np.sort(-(5 + 1000 * rng.random(1 + 90 * seed) ** 6).astype(np.int64))
    lengths = S.code_lengths(grouped(counts))
    assert sum(lengths.values()) == len(counts)
    code, size = S.codes(np.arange(len(counts)), lengths)
    assert (counts * size).sum() == huffman_cost(counts.tolist())
    words = [f"{c:b}".zfill(n) if n else "" for c, n in zip(code.tolist(), size.tolist(), strict=True)]
    assert all(len(w) == n for w, n in zip(words, size, strict=True))
    assert len(set(words)) == len(words) and not any(a != b and b.startswith(a) for a in words for b in words if len(words) > 1)
    nodes, path, target = S.paths(code, size)
    assert len(nodes) == len(counts) - 1 and ((path < len(nodes)).sum(axis=0) == size).all()


def corpus(n=240, seed=1):
    """Texts on one of four themes, with words of their own and words of all."""
    rng = np.random.default_rng(seed)
    texts = []
    for i in range(n):
        own = rng.integers(0, 12, 40)
        texts.append([f"all{rng.integers(8)}" if rng.random() < 0.3 else f"t{i % 4}w{k}" for k in own])
    return texts


def coded(texts):
    words, number = np.unique([w for t in texts for w in t], return_counts=True)
    order = np.lexsort((words, -number))
    rank = {w: i for i, w in enumerate(words[order])}
    return [np.array([rank[w] for w in t], np.int32) for t in texts], S.code_lengths(grouped(number)), len(words)


def loss(pairs, path, target, words, nodes):
    word, other, times = pairs
    nodes = np.vstack([nodes, np.zeros((1, nodes.shape[1]))])
    out = np.einsum("pd,lpd->lp", words[other], nodes[path[:, word]]) * (2 * target[:, word] - 1)
    return (np.logaddexp(0, -out) * (path[:, word] < len(nodes) - 1) * times).sum() / times.sum()


def one_by_one(texts, size, path, target, words):
    """Plain skip-gram, pair after pair."""
    rng, words, nodes = np.random.default_rng(4), words.copy(), np.zeros((path.max() + 1, words.shape[1]), np.float32)
    total, done = sum(map(len, texts)), 0
    for text in texts:
        for i, w in enumerate(text):
            rate, reach, on = S.RATE * (1 - done / total), rng.integers(1, S.WINDOW + 1), path[: size[w], w]
            done += 1
            for j in range(max(0, i - reach), min(len(text), i + reach + 1)):
                if j != i:
                    u, v = words[text[j]].copy(), nodes[on].copy()
                    g = (target[: size[w], w] - 1 / (1 + np.exp(-(v @ u)))) * rate
                    nodes[on] += g[:, None] * u
                    words[text[j]] += g @ v
    return words, nodes


def test_trainer_learns_as_much_as_plain_skip_gram(monkeypatch):
    monkeypatch.setattr(S, "BATCH", 256)
    monkeypatch.setattr(S, "SEGMENT", 800)
    texts, lengths, n = coded(corpus())
    code, size = S.codes(np.arange(n), lengths)
    _, path, target = S.paths(code, size)
    first = S.start(np.arange(n), 8, 42)
    pairs = S.pair_counts(np.concatenate(texts), np.repeat(np.arange(len(texts)), 40), n, np.random.default_rng(0))
    _, words, _, _, nodes = S.train(texts, np.arange(n), lengths, first, {}, 42)
    untrained = loss(pairs, path, target, first, np.zeros_like(nodes))
    plain = loss(pairs, path, target, *one_by_one(texts, size, path, target, first))
    assert plain < untrained and loss(pairs, path, target, words, nodes) < untrained - 0.9 * (untrained - plain)


def test_segments_lose_no_pair(monkeypatch):
    monkeypatch.setattr(S, "WINDOW", 1)
    monkeypatch.setattr(S, "SEGMENT", 50)
    texts, lengths, n = coded(corpus())
    pairs = S.train(texts, np.arange(n), lengths, S.start(np.arange(n), 4, 42), {}, 42)[0]
    assert pairs.sum() == 2 * 39 * len(texts)


def test_a_step_adds_every_gradient_of_a_row():
    rng = np.random.default_rng(2)
    at, grad, bend = rng.integers(0, 30, 50), rng.normal(size=(50, 3)).astype(np.float32), rng.random(50)
    rows = np.zeros((31, 3), np.float32)
    S.add_to(rows, np.zeros(31, np.int64), [(at[:20], grad[:20], bend[:20]), (at[20:], grad[20:], bend[20:])])
    for i in range(30):
        assert np.allclose(rows[i], grad[at == i].sum(axis=0) / (1 + bend[at == i].sum()), atol=1e-5)


@pytest.mark.parametrize("epochs", [1, 3])
def test_word2vec_by_shards(spark, monkeypatch, epochs):
    monkeypatch.setattr(S, "SHARD_TOKENS", 3000)
    texts = corpus()
    rows = [(i % 200, " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "rare words"), (None, "all1"), (903, "all1 rare")]
    docs = spark.createDataFrame(rows, "id long, s string").repartition(3)
    found = E.embed_word2vec(docs, "id", "s", dim=16, partitions=3, max_iter=epochs)
    assert found.dtypes == [("id", "bigint"), ("embedding", "array<float>")]
    got = [(r.id, np.array(r.embedding)) for r in found.collect()]
    assert sorted(str(i) for i, _ in got) == sorted(str(i) for i, _ in rows)
    by_id = {i: v for i, v in got if i is None or i >= 900}
    assert all((by_id[i] == 0).all() and len(by_id[i]) == 16 for i in (900, 901, 902))
    assert np.abs(by_id[None]).max() > 0 and np.allclose(by_id[903] * 2, by_id[None], atol=1e-6)
    # Texts of a theme are nearer to one another than to others (ids below 200 and i % 4 agree, as 200 is divisible by 4).
    m = np.array([v for i, v in got if i is not None and i < 200])
    theme = np.array([i % 4 for i, _ in got if i is not None and i < 200])
    m = m - m.mean(axis=0)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    near, same = m @ m.T, theme[:, None] == theme
    np.fill_diagonal(near, -2)
    assert (theme[near.argmax(axis=1)] == theme).mean() > 0.8 and near[same].mean() > near[~same].mean()
    again = E.embed_word2vec(docs, "id", "s", dim=16, partitions=3, max_iter=epochs).where("id = 903").first().embedding
    assert np.allclose(again, by_id[903], atol=1e-6)


def test_no_word_is_an_error(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "id long, s string")
    with pytest.raises(ValueError, match="no word"):
        E.embed_word2vec(docs, "id", "s", dim=4)
    alone = E.embed_word2vec(spark.createDataFrame([(1, "a " * 9)], "id long, s string"), "id", "s", dim=4).first()
    assert np.isfinite(alone.embedding).all() and any(alone.embedding)
