from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkatlas.operators import chunking as K
from talkatlas.operators import classify as C
from talkatlas.operators import embed as E
from talkatlas.operators import features as X
from talkatlas.operators import summarise as Z
from talkatlas.operators import tfidf as I
from talkatlas.operators.recommend import recommend_by_terms


@pytest.mark.parametrize("max_length", [500, 7])
def test_chunk_plan_equals_array_split(spark, max_length):
    lengths = [0, 1, 6, 7, 8, 14, 499, 500, 501, 1000, 1001]
    df = spark.createDataFrame([(n, n) for n in lengths], "id long, n long")
    plan: dict[int, list] = {}
    for r in K.chunk_plan(df, "id", "n", max_length).orderBy("id", "chunk_ix").collect():
        plan.setdefault(r.id, []).append(r)
    for n in lengths:
        parts = np.array_split(np.arange(n), max(1, math.ceil(n / max_length)))
        assert [r.chunk_length for r in plan[n]] == [len(p) for p in parts]
        assert [r.chunk_start for r in plan[n] if r.chunk_length] == [p[0] for p in parts if len(p)]
        assert {r.budget for r in plan[n]} == {max(1, int(max_length / len(parts)))}


def test_budget_never_falls_below_one(spark):
    df = spark.createDataFrame([(1, 250001)], "id long, n long")
    assert K.chunk_plan(df, "id", "n").agg(F.min("budget")).first()[0] == 1


def test_chunk_of_agrees_with_the_plan(spark):
    df = spark.range(1001).select(K.chunk_of(F.lit(1001), F.lit(3), F.col("id")).alias("c"))
    assert [r["count"] for r in df.groupBy("c").count().orderBy("c").collect()] == [334, 334, 333]


def test_chunks_join_back_to_the_tokens(spark):
    docs = spark.createDataFrame([(0, " ".join(f"w{i}" for i in range(23))), (1, ""), (2, None)], "id long, s string")
    chunks = K.chunk_text(docs, "id", "s", 5)
    assert {r.id: r["count"] for r in chunks.groupBy("id").count().collect()} == {0: 5, 1: 1, 2: 1}
    joined = {r.id: r.s for r in K.concat_chunks(chunks, "id", "chunk_ix", "chunk_text", "s").collect()}
    assert joined == {0: docs.first().s, 1: "", 2: ""}


def docs_small(spark):
    rows = [(0, "cat dog cat"), (1, "dog bird"), (2, "fish a"), (3, ""), (4, None)]
    return spark.createDataFrame(rows, "id long, s string")


def test_tfidf_l2_by_hand(spark):
    got = {(r.id, r.term): r.weight for r in I.tfidf_l2(docs_small(spark), "id", "s").collect()}
    idf = lambda df: math.log(6 / (1 + df)) + 1
    cat, dog = 2 * idf(1), idf(2)
    size = math.hypot(cat, dog)
    assert got.keys() == {(0, "cat"), (0, "dog"), (1, "dog"), (1, "bird"), (2, "fish")}
    assert math.isclose(got[0, "cat"], cat / size) and math.isclose(got[0, "dog"], dog / size)
    assert math.isclose(got[2, "fish"], 1.0)


def test_tfidf_unsmoothed_is_the_ml_formula(spark):
    got = {(r.id, r.term): r.weight for r in I.tfidf_unsmoothed(docs_small(spark), "id", "s").collect()}
    assert math.isclose(got[0, "cat"], 2 * math.log(6 / 2)) and math.isclose(got[1, "dog"], math.log(6 / 3))


def test_tfidf_ignores_partitioning(spark):
    docs = docs_small(spark)
    rounded = lambda df: sorted((r.id, r.term, round(r.weight, 9)) for r in df.collect())
    assert rounded(I.tfidf_l2(docs.repartition(1), "id", "s")) == rounded(I.tfidf_l2(docs.repartition(7), "id", "s"))


def test_recommendations_by_terms_fill_up_with_zero(spark):
    rows = [(0, "cat dog", "x"), (1, "cat dog", "y"), (2, "fish", "y"), (3, "cat", "y"), (4, "bird", "z"), (5, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, s string, category string")
    found = recommend_by_terms(docs, "doc_id", "s", "category", k=6).where("query_category = 'x'")
    got = found.orderBy("rank").collect()
    assert [r.doc_id for r in got] == [1, 3, 2, 4, 5]
    assert [r.sim for r in got][0] == 1.0 and [r.sim for r in got][2:] == [0.0, 0.0, 0.0]
    assert len(recommend_by_terms(docs, "doc_id", "s", "category", k=3).collect()) == 6


def test_summary_keeps_the_best_span_of_each_chunk(spark):
    # Weights before normalising: aa 10 * (ln(5/3) + 1) = 15.1; each other term ln(5/2) + 1 = 1.9.
    common = ["aa"] * 4
    text = " ".join(common + ["rare", "odd", "aa", "aa"] + common + ["zz", "yy", "xx", "ww"])
    docs = spark.createDataFrame([(0, text), (1, "aa aa aa"), (2, ""), (3, None)], "id long, s string")
    got = {r.id: r.summary for r in Z.summarise(docs, "id", "s", max_length=8, span=4).collect()}
    assert got == {0: "rare odd aa aa aa aa aa aa", 1: "aa aa aa", 2: "", 3: ""}


def test_model_summaries_are_joined_in_order(spark):
    def make():
        def predict(texts):
            return np.array([t.split()[0] if t else "" for t in texts], dtype=object)

        return predict

    docs = spark.createDataFrame([(0, "a b c d e f")], "id long, s string")
    assert Z.summarise_with_model(docs, "id", "s", make, max_length=2, sep="").first().summary == "ace"


def test_sample_summaries(spark):
    docs = spark.range(50).select(F.col("id"), F.concat_ws(" ", F.lit("doc"), F.col("id").cast("string")).alias("s"))
    assert Z.summarise_sample(docs, "id", "s", 5).count() == 5


def separable(spark):
    words = {"a": "apple pear plum", "b": "stone rock sand", "c": "river lake sea"}
    rows = [(i, f"{words['abc'[i % 3]]} the {i}", "abc"[i % 3]) for i in range(90)]
    rows += [(90, "lost text", None), (91, None, "a")]
    return spark.createDataFrame(rows, "id long, summary string, category string")


@pytest.mark.parametrize(
    "kind, grid",
    [
        ("random_forest", {"numTrees": [10, 20], "maxDepth": [5]}),
        ("linear_svc", {"tol": [1e-1], "C": [0.1, 1.0], "maxIter": [10]}),
        ("boosted_trees", {"maxIter": [2], "maxDepth": [2, 3]}),
    ],
)
def test_grid_search_on_separable_text(spark, kind, grid):
    train, test = C.prepare(separable(spark), "id", "summary", "category", folds=2)
    assert train.count() + test.count() == 90
    result = C.grid_search(train, test, kind, grid, folds=2)
    assert result.accuracy > 0.5  # the largest class holds a third of the rows
    rows = result.grid.collect()
    assert len(rows) == 2 and set(rows[0].asDict()) == {*grid, "avg_metric"}
    assert set(result.best_params) == set(grid) and all(result.best_params[p] in grid[p] for p in grid)
    assert C.accuracy(result.predictions).first().accuracy == pytest.approx(result.accuracy)


def test_features_fit_on_train_or_all(spark):
    train, _ = C.prepare(separable(spark), "id", "summary", "category", folds=2)
    leaky, _ = C.prepare(separable(spark), "id", "summary", "category", folds=2, fit_on="all")
    assert train.count() == leaky.count()
    assert train.orderBy("id").first().tfidf != leaky.orderBy("id").first().tfidf
    assert X.create_tfidf(separable(spark)).columns == ["category", "summary", "tfidf"]


def test_words_are_counted_and_written_once(spark, monkeypatch):
    written, plain = [], C.cut
    monkeypatch.setattr(C, "cut", lambda df: written.append(df.columns) or plain(df))
    train, test = C.prepare(separable(spark), "id", "summary", "category", folds=2)
    assert written == [["id", "label", "fold", "tf"]] * 2  # training and test rows; no pass of its own for the document frequencies
    assert train.columns == test.columns == ["id", "label", "fold", "tfidf", "tf"]


def test_hashed_embeddings_keep_every_word(spark):
    rows = [(1, "apple pear apple"), (2, "apple pear apple zyzzyva"), (3, "Apple, PEAR; apple!"), (4, ""), (5, None), (6, "... !!")]
    docs = spark.createDataFrame(rows, "id long, s string")
    got = {r.id: np.array(r.embedding) for r in E.embed_hashed(docs, "id", "s").collect()}
    assert len(got) == 6 and all(len(v) == 768 for v in got.values())
    assert np.linalg.norm(got[1]) == pytest.approx(1) and (got[1] == got[3]).all()
    assert all(not got[i].any() for i in (4, 5, 6))
    assert (got[2] != got[1]).any() and np.count_nonzero(got[2]) == 3
    assert sorted(abs(got[1][got[1] != 0])) == pytest.approx([1 / 5**0.5, 2 / 5**0.5])
    assert (np.array(E.embed_hashed(docs, "id", "s", dim=8).where("id = 1").first().embedding) != 0).sum() <= 2
    assert E.embed_hashed(docs.limit(0), "id", "s").count() == 0
