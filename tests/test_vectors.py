from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas.functions import vector as V
from talkatlas.operators import classify as C
from talkatlas.operators import embed as E
from talkatlas.operators import knn
from talkatlas.operators import recommend as R
from talkatlas.operators.knn import nearest
from talkatlas.sources.vectors import last_per_title

SCHEMA = "vec_id long, embedding array<float>, category string, fold int"


def vectors_small(spark):
    rows = [
        (0, [1.0, 0.0, 0.0], "a", 0),
        (1, [2.0, 0.0, 0.0], "a", 1),
        (2, [1.0, 0.0, 0.0], "b", 0),
        (3, [0.0, 0.0, 0.0], "b", 1),
        (4, [-1.0, 0.0, 0.0], "c", 0),
        (5, [0.0, 1.0, 1.0], "a", 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def many(spark, n=700, dim=5, copies=250):
    """A third of the rows are copies of one vector."""
    rng = np.random.default_rng(3)
    m = np.round(rng.normal(size=(n, dim)), 2).astype(np.float32)
    m[:copies] = m[0]
    return m, spark.createDataFrame([(i, m[i].tolist(), "xyz"[i % 3], i % 4) for i in range(n)], SCHEMA).repartition(7)


def by_hand(m, k, metric, fold=None):
    m = m.astype(np.float64)
    found = {}
    for q in range(len(m)):
        scored = []
        for c in range(len(m)):
            if c == q or (fold is not None and fold(c) == fold(q)):
                continue
            if metric == "cosine":
                size = np.linalg.norm(m[q]) * np.linalg.norm(m[c])
                scored.append((-round(float(m[q] @ m[c] / size), 6) if size else 0.0, c))
            else:
                scored.append((round(float(np.linalg.norm(m[q] - m[c])), 6), c))
        found[q] = [c for _, c in sorted(scored)[:k]]
    return found


def as_lists(df):
    lists: dict[int, list] = {}
    for r in df.orderBy("query_vec_id", "rank").collect():
        lists.setdefault(r.query_vec_id, []).append(r.vec_id)
    return lists


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("how", [{"strategy": "broadcast"}, {"strategy": "tiled"}, {"strategy": "tiled", "block_rows": 90}])
def test_nearest_equals_brute_force(spark, metric, how):
    m, df = many(spark)
    got = nearest(df, df, 6, row_id="vec_id", vector="embedding", dim=5, metric=metric, **how)
    assert as_lists(got) == by_hand(m, 6, metric)


def test_nearest_skips_the_own_fold(spark):
    m, df = many(spark, n=200, copies=70)
    got = nearest(
        df, df, 4, row_id="vec_id", vector="embedding", dim=5, exclude="fold", strategy="tiled", block_rows=64
    )
    assert as_lists(got) == by_hand(m, 4, "cosine", fold=lambda i: i % 4)


def test_nearest_with_few_candidates_and_bad_rows(spark):
    bad = [
        (9, [1.0], "a", 0), (10, None, "a", 0), (11, [1.0, None, 0.0], "a", 0), (12, [float("nan"), 0.0, 1.0], "a", 0),
        (13, [float("inf"), 0.0, 1.0], "a", 0), (None, [1.0, 0.0, 0.0], "a", 0), (14, [], "a", 0),
    ]
    df = vectors_small(spark).unionByName(spark.createDataFrame(bad, SCHEMA))
    for how in ({"strategy": "broadcast"}, {"strategy": "tiled", "block_rows": 2}, {"broadcast_bytes": 0}):
        got = nearest(df, df, 50, row_id="vec_id", vector="embedding", dim=3, **how)
        lists = as_lists(got)
        assert set(lists) == set(range(6)) and all(len(v) == 5 for v in lists.values())
        assert lists[0] == [1, 2, 3, 5, 4]


def test_recommend_leaves_out_bad_rows_and_unknown_ids(spark):
    bad = [(9, [1.0], "a", 0), (10, None, "a", 0), (11, [1.0, None, 0.0], "a", 0), (12, [float("nan"), 0.0, 1.0], "a", 0), (None, [1.0, 0.0, 0.0], "a", 0)]
    clean = vectors_small(spark)
    df = clean.unionByName(spark.createDataFrame(bad, SCHEMA))
    want = R.recommend(clean, "vec_id", 0, "embedding").collect()
    assert len(want) == 5 and R.recommend(df, "vec_id", 0, "embedding").collect() == want
    for query in (999, 10, 11, 12):
        assert R.recommend(df, "vec_id", query, "embedding").count() == 0


def test_vector_expressions(spark):
    row = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    got = row.select(
        V.dot(F.col("a"), F.col("b")), V.l2_norm(F.col("a")), V.cosine(F.col("a"), F.col("b")), V.cosine(F.col("a"), F.col("z"))
    ).first()
    assert tuple(got) == (24.0, 5.0, 0.96, 0.0)


def test_scores_and_recommendations(spark):
    df = vectors_small(spark)
    scores = {r.vec_id: r.sim for r in R.cosine_scores(df, df.where("vec_id = 0"), "embedding").collect()}
    assert scores == {0: 1.0, 1: 1.0, 2: 1.0, 3: 0.0, 4: -1.0, 5: 0.0}
    assert all(not math.isnan(s) for s in scores.values())
    assert [r.vec_id for r in R.recommend(df, "vec_id", 0, "embedding", k=4).collect()] == [1, 2, 3]
    top = R.recommend_all(df, "vec_id", "embedding", 3, "category", k=3)
    hits = {r.query_vec_id: (r.n_neighbours, r.n_hits) for r in R.neighbour_hits(top, "vec_id", "category").collect()}
    assert hits[0] == (2, 1) and hits[2] == (2, 0)
    rates = {r.category: (r.n_queries, round(r.hit_rate, 4)) for r in R.hit_rate(top, "category").collect()}
    assert rates == {"a": (3, 1.0), "b": (2, 0.0), "c": (1, 0.0)}


def test_last_vector_of_a_title_wins(spark):
    df = spark.createDataFrame([("t", 0, [1.0]), ("t", 2, [3.0]), ("t", 1, [2.0]), ("u", 3, [4.0])], "t string, ix long, v array<float>")
    assert {r.t: r.v for r in last_per_title(df, "t", "v", "ix").collect()} == {"t": [3.0], "u": [4.0]}


def test_pooling(spark):
    df = spark.createDataFrame(
        [(0, 0, [1.0, 2.0]), (0, 1, [3.0, 6.0]), (1, 0, [5.0, 5.0])], "doc long, pos long, vec array<float>"
    )
    assert {r.doc: r.embedding for r in E.pool_mean(df, "doc", "vec").collect()} == {0: [2.0, 4.0], 1: [5.0, 5.0]}
    assert {r.doc: r.embedding for r in E.pool_last(df, "doc", "pos", "vec").collect()} == {0: [3.0, 6.0], 1: [5.0, 5.0]}


def test_embed_batch_checks_the_width(spark):
    def make():
        def predict(texts):
            return np.array([[len(t), 1.0] for t in texts], dtype=np.float32)

        return predict

    df = spark.createDataFrame([(0, "ab"), (1, "")], "id long, s string")
    assert {r.id: r.embedding for r in E.embed_batch(df, "s", make, 2).collect()} == {0: [2.0, 1.0], 1: [0.0, 1.0]}
    with pytest.raises(Exception, match="must return 3 values"):
        E.embed_batch(df, "s", make, 3).collect()


def test_votes_break_ties_by_label(spark):
    rows = [(0, 1, "b"), (0, 2, "a"), (0, 3, "b"), (0, 4, "a"), (0, 5, "c")]
    df = spark.createDataFrame(rows, "query_vec_id long, rank long, category string")
    got = {r.k: r.prediction for r in C.majority_vote(df, "vec_id", "category", [1, 3, 4]).collect()}
    assert got == {1: "b", 3: "b", 4: "a"}


def test_knn_on_a_separable_table(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=4) * 0.1 + 3 * np.eye(4)[i % 3]).tolist(), "abc"[i % 3], (i // 3) % 5) for i in range(90)]
    df = spark.createDataFrame(rows, SCHEMA)
    done = C.knn_classify(
        df.where("vec_id < 60"), df.where("vec_id >= 60"), 5, row_id="vec_id", vector="embedding", dim=4, label="category",
        metric="euclidean",
    )
    assert C.accuracy(done, "category").first().accuracy == 1.0
    grid = C.knn_grid(df, row_id="vec_id", vector="embedding", dim=4, label="category")
    assert sorted((r.k, r.metric, r.avg_metric) for r in grid.collect()) == sorted(
        (k, m, 1.0) for k in (5, 10, 15) for m in ("cosine", "euclidean")
    )


def test_best_columns_equal_a_full_sort(monkeypatch):
    rng = np.random.default_rng(0)
    for _ in range(200):
        rows, cols, k = int(rng.integers(1, 8)), int(rng.integers(1, 60)), int(rng.integers(1, 12))
        monkeypatch.setattr(knn, "HEAD_COLUMNS", int(rng.integers(1, 20)))
        monkeypatch.setattr(knn, "CROWDED", int(rng.integers(1, 3)))
        scores = np.round(rng.normal(size=(rows, cols)), int(rng.integers(0, 3))) + rng.normal(size=(rows, cols)) * 1e-7
        scores[rng.random((rows, cols)) < rng.choice([0, 0.2, 0.9])] = -np.inf
        got: dict[int, set] = {}
        for r, c, v in zip(*knn._best(scores.copy(), k)):
            got.setdefault(int(r), set()).add((float(v), int(c)))
        rounded = np.round(scores, 6) + 0.0
        for r in range(rows):
            allowed = [c for c in range(cols) if np.isfinite(rounded[r, c])]
            best = sorted(allowed, key=lambda c: (-rounded[r, c], c))[:k]
            assert got.get(r, set()) == {(float(rounded[r, c]), c) for c in best}
