from __future__ import annotations

import numpy as np
import pytest

from talkatlas.llm import embedding

SCHEMA = "vec_id long, embedding array<float>, label int, node long, sim double"
INF = float("inf")


def planted(spark):
    rng = np.random.default_rng(1)
    rows, n = [], 0

    def add(vector, label, vec_id="next"):
        nonlocal n
        n += 1
        own = None if vector is None else [None if x is None else float(np.float32(x)) for x in vector]
        rows.append((n * 7 % 1009 if vec_id == "next" else vec_id, own, label, 1, 2.0))

    for label in range(3):
        for _ in range(120):
            base = rng.normal(size=16)
            add(base, label)
            if rng.random() < 0.3:
                for _ in range(rng.integers(1, 4)):
                    add(base + rng.normal(size=16) * rng.choice([0.02, 0.1, 0.2]), label)
    dense = rng.normal(size=16)
    for _ in range(130):
        add(dense + rng.normal(size=16) * 0.12, 1)
    for _ in range(40):
        add(dense, 2)
    walk = rng.normal(size=16)
    for _ in range(30):  # a chain whose ends do not link
        walk = walk + rng.normal(size=16) * 0.2
        add(walk, 0)
    for odd in (None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [INF] + [0.0] * 15):
        add(odd, 1)
        add(odd, 1)
    add(dense, None)
    add(dense[:4], 2)
    add(dense[:4], 2)
    add(dense, 2, None)
    add(dense * 3, 2)
    return rows, spark.createDataFrame(rows, SCHEMA)


def slow(rows):
    def ok(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    n = len(rows)
    linked = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            (_, u, a, *_), (_, v, b, *_) = rows[i], rows[j]
            if i != j and a == b and ok(u, a) and ok(v, b) and len(u) == len(v):
                linked[i, j] = np.dot(u, v) / np.sqrt(np.dot(u, u) * np.dot(v, v)) >= embedding.THRESHOLD
    ids = np.array([10**9 if r[0] is None else r[0] for r in rows])
    label = ids.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], 10**9).min(axis=1))
        if (new == label).all():
            return [(r[0], int(linked[k].sum()), None if label[k] == 10**9 else int(label[k])) for k, r in enumerate(rows)]
        label = new


@pytest.mark.parametrize("block", [512, 16])
def test_links_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding, "BLOCK", block)
    rows, df = planted(spark)
    got = embedding.near_vectors(df).collect()
    want = slow(rows)
    assert sorted(map(str, [(r.vec_id, r.n_links, r.component_id) for r in got])) == sorted(map(str, want))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert max(r.n_links for r in got) > 100


def test_empty_table(spark):
    _, df = planted(spark)
    assert embedding.near_vectors(df.limit(0)).count() == 0


def components(unit):
    linked = unit @ unit.T >= embedding.THRESHOLD
    np.fill_diagonal(linked, False)
    label = np.arange(len(unit))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(unit)).min(axis=1))
        if (new == label).all():
            return linked.sum(axis=1), label
        label = new


def bridged(spark, others=3000, size=60):
    """Two tight groups, linked across but with more near vectors of their own than a list holds, among others."""
    rng = np.random.default_rng(5)
    u, v = np.eye(32)[0], 0.955 * np.eye(32)[0] + np.sqrt(1 - 0.955**2) * np.eye(32)[1]
    groups = np.concatenate([x + rng.normal(size=(size, 32)) * 0.0125 for x in (u, v)])
    unit = np.concatenate([rng.normal(size=(others, 32)), groups]).astype(np.float32).astype(float)
    rows = [(i, [float(y) for y in x], 1, 1, 2.0) for i, x in enumerate(unit)]
    return unit / np.linalg.norm(unit, axis=1, keepdims=True), spark.createDataFrame(rows, SCHEMA)


def test_links_across_full_lists_join_groups(spark, monkeypatch):
    monkeypatch.setattr(embedding, "AUDIT", 0)  # the search alone
    unit, df = bridged(spark)
    links, label = components(unit)
    assert len(set(label[-120:])) == 1 and links[-1] > 2 * embedding.MAX_ROOM
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_vectors(df).collect()}
    assert got == {i: (int(links[i]), int(label[i])) for i in range(len(unit))}


def test_a_search_that_misses_links_ends_in_exact_comparison(spark, monkeypatch):
    monkeypatch.setattr(embedding, "SEARCHES", 1)
    monkeypatch.setattr(embedding, "ROUNDS", 0)
    monkeypatch.setattr(embedding, "TABLES", 1)
    monkeypatch.setattr(embedding, "REACH", 1)
    monkeypatch.setattr(embedding, "AUDIT", 200)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(600, 16))
    unit = np.concatenate([base, base + rng.normal(size=base.shape) * 0.2]).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, [float(y) for y in x], 1, 1, 2.0) for i, x in enumerate(unit)], SCHEMA)
    links, label = components(unit / np.linalg.norm(unit, axis=1, keepdims=True))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near_vectors(df).collect()}
    assert got == {i: (int(links[i]), int(label[i])) for i in range(len(unit))} and links.sum() > 1000
