"""Every registered query against its SQL twin, or for content where it has none."""

from __future__ import annotations

import __spark_entry__ as entry_points
import oracle
import pytest

QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, con, sf_dir, name):
    assert oracle.differences(spark, con, sf_dir, QUERIES[name], ORACLE[name]) == []


MODELS = {"classify_rf", "classify_svc", "classify_gbt", "grid_results", "embed_word2vec"}
CORPUS = {name for name in QUERIES if name.startswith("op") or name == "pipeline"}  # tested with their operators


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS - CORPUS))
def test_no_plan_has_a_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_the_columns_they_need(spark, sf_dir):
    plan = QUERIES["doc_lookup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,8)" in plan
    plan = QUERIES["playlist_title_count"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string,source:string,n_chars:bigint>" in plan


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 9
    assert [r.sim for r in rows] == sorted((r.sim for r in rows), reverse=True)


def test_oracle_keys_are_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_hashing_tf_counts_every_token(spark, sf_dir):
    got = QUERIES["hashing_tf"](spark, sf_dir).groupBy("category").sum("total").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text").collect()
    expected: dict[str, float] = {}
    for d in docs:
        # Spark's Tokenizer drops trailing empty tokens only.
        tokens = d.text.lower()
        for ws in "\t\n\x0b\f\r":
            tokens = tokens.replace(ws, " ")
        expected[d.lang] = expected.get(d.lang, 0) + len(tokens.rstrip(" ").split(" "))
    assert {r[0]: r[1] for r in got} == expected


def test_word2vec_embeds_every_document(spark, sf_dir):
    rows = QUERIES["embed_word2vec"](spark, sf_dir).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(len(r.embedding) == 32 for r in rows)
