from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas.operators import term_index as TI
from talkatlas.operators.knn import DIGITS
from talkatlas.operators.tfidf import tfidf_l2
from talkatlas.session import scratch_path


def near_copies(n=300, seed=3):
    """Texts over words of very different frequency: groups of near copies, repeated, empty and NULL texts."""
    rng = np.random.default_rng(seed)
    words = np.array([f"w{i}" for i in range(4000)])
    share = 1 / np.arange(1, len(words) + 1)
    rows = []
    while len(rows) < n:
        base = rng.choice(words, size=int(rng.integers(1, 120)), p=share / share.sum())
        for _ in range(int(rng.integers(1, 25))):
            text = np.where(rng.random(len(base)) < 0.1, rng.choice(words, size=len(base)), base)
            rows.append((len(rows), " ".join(text)))
    rows += [(9000, rows[0][1]), (9001, ""), (9002, None), (9003, "a b"), (None, rows[0][1])]
    return rows


def indexed(spark, rows):
    docs = spark.createDataFrame(rows, "id long, s string").repartition(5)
    path = scratch_path(spark, "terms")
    TI.build_term_index(docs, path, "id", "s")
    return docs.where("id IS NOT NULL"), TI.open_term_index(spark, path, "id")


def plain(docs, query, k):
    """All scores of one query, in order."""
    weights: dict[int, dict[str, float]] = {r.id: {} for r in docs.select("id").collect()}
    for r in tfidf_l2(docs, "id", "s").collect():
        weights[r.id][r.term] = r.weight
    sims = [(sum(w * weights[query].get(t, 0.0) for t, w in own.items()), i) for i, own in weights.items() if i != query]
    return sorted(((i, round(s, DIGITS)) for s, i in sims), key=lambda p: (-p[1], p[0]))[:k]


@pytest.fixture(scope="module")
def corpus(spark):
    return indexed(spark, near_copies())


@pytest.mark.parametrize("k", [1, 9, 400])
def test_search_equals_comparison_with_every_document(spark, corpus, k):
    docs, index = corpus
    asked = [0, 7, 120, 9000, 9001, 9002, 9003]
    queries = spark.createDataFrame([(i,) for i in [*asked, 7, 123456, None]], "query_id long")
    found, _ = TI.search(index, queries, k)
    got: dict[int, list] = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.id, r.sim, r["rank"]))
    assert sorted(got) == asked
    for query, rows in got.items():
        expected = plain(docs, query, k)
        assert [r[2] for r in rows] == list(range(1, len(expected) + 1))
        assert [r[1] for r in rows] == pytest.approx([s for _, s in expected], abs=1.5e-6)
        assert [r[0] for r in rows] == [i for i, _ in expected]


def test_near_copies_are_found_from_few_postings(spark, corpus):
    docs, index = corpus
    queries = docs.where("id < 300").select(F.col("id").alias("query_id"))
    found, effort = TI.search(index, queries, 3)
    rows = effort.join(found.where("rank = 3").select("query_id", F.col("sim").alias("third")), "query_id").collect()
    assert len(rows) == 300
    assert sum(r.n_read for r in rows) < 0.7 * sum(r.n_postings for r in rows)
    close = [r for r in rows if r.third >= 0.8]
    assert len(close) > 50
    assert sum(r.n_read for r in close) < 0.25 * sum(r.n_postings for r in close)
    assert sum(r.n_candidates for r in close) < 0.2 * 300 * len(close)


def test_query_terms_alone_are_broadcast(spark, corpus):
    """Postings go to their query by a measured broadcast; only sums per pair are shuffled."""
    _, index = corpus
    asked = TI._asked_terms(index, spark.createDataFrame([(1,)], "query_id long"))
    plan = TI._reached(index, asked)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.index("HashAggregate") < plan.index("Exchange hashpartitioning")


def test_empty_tables(spark, corpus):
    _, index = corpus
    none = spark.createDataFrame([], "query_id long")
    found, effort = TI.search(index, none, 3)
    assert found.count() == effort.count() == 0
    _, empty = indexed(spark, [(None, None)])
    found, effort = TI.search(empty, spark.createDataFrame([(1,)], "query_id long"), 3)
    assert found.count() == effort.count() == 0
