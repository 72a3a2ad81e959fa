"""Lookups are broadcast by their measured size, and hot keys stay whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkatlas import session
from talkatlas.operators import chunking, lemma, skew, summarise, term_index, tfidf


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_lookup_is_broadcast_and_large_one_is_not(spark):
    rows = spark.range(1000).withColumn("key", F.col("id") % 7)
    small = spark.range(4).select(F.col("id").alias("key"), F.lit("a").alias("name"))
    # Both lookups come from plans whose estimates are far off.
    large = spark.range(2_000_001).groupBy((F.col("id") % 2_000_001).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    assert "BroadcastHashJoin" in plan(skew.skew_join(rows, small, "key", "left"))
    joined = skew.skew_join(rows, large, "key")
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
    assert joined.count() == 1000


def test_long_strings_count(spark):
    wide = spark.range(10).select(F.col("id").alias("key"), F.repeat(F.lit("x"), 1000).alias("name"), F.array(F.lit(1)).alias("a"))
    assert 10_000 < skew.measured_bytes(wide) < 11_000
    assert skew.measured_bytes(wide.limit(0)) == 0


def test_both_joins_give_the_same_rows(spark):
    rows = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 90))
    lookup = spark.range(80).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    for how in ("inner", "left"):
        a, b = (skew.skew_join(rows, lookup, "key", how, limit) for limit in (skew.LOOKUP_BYTES, 0))
        assert "SortMergeJoin" in plan(b)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == b.count()


def test_frequent_keys_stay_and_only_the_others_are_moved(spark):
    rows = spark.range(5000).select("id", F.floor(F.sqrt("id") * 10).cast("string").alias("key"))
    rows = rows.unionByName(spark.range(3000).select("id", F.lit("hot").alias("key"))).unionByName(spark.range(9).select("id", F.lit(None).cast("string").alias("key")))
    lookup = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    want = rows.join(lookup, "key")
    for limit in (0, 2000, 20_000, skew.LOOKUP_BYTES):
        got = skew.frequent_join(rows, lookup, "key", "n", limit)
        assert ("SortMergeJoin" in plan(got)) == (limit < skew.LOOKUP_BYTES)
        assert ("BroadcastHashJoin" in plan(got)) and got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def texts(spark, n=400):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), (i * F.col("id")) % 97, F.lit("s"))))
    return spark.range(n).select("id", words.alias("text"))


def test_tasks_follow_the_bytes_of_the_texts(spark, monkeypatch):
    docs = texts(spark)
    few = tfidf.term_counts(docs, "id", "text")
    monkeypatch.setattr(session, "PART_BYTES", 2000)
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    many = tfidf.term_counts(docs, "id", "text")
    assert few.rdd.getNumPartitions() <= 8 and many.rdd.getNumPartitions() == -(-held // 2000) > 30
    assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    weights = tfidf.tfidf_l2(docs, "id", "text")
    assert weights.rdd.getNumPartitions() == -(-held // 2000)


def test_words_do_not_leave_their_texts_for_a_small_lookup(spark):
    docs = texts(spark).withColumn("text", F.when(F.col("id") % 7 > 0, F.col("text")).otherwise(""))
    lemmas = spark.createDataFrame([("w1s", "w1"), ("w2s", "w2")], "token string, lemma string")
    done = lemma.lemmatise(docs, "id", "text", lemmas, ["w3s"])
    assert plan(done).count("Exchange hashpartitioning") == 1
    rows = {r.id: r.text.split() for r in docs.collect()}
    change = {"w1s": "w1", "w2s": "w2"}
    assert {r.id: r.lemmas for r in done.collect()} == {i: " ".join(change.get(w, w) for w in ws if w != "w3s") for i, ws in rows.items()}


def test_places_meet_texts_and_not_tokens(spark):
    docs = texts(spark, 30)
    joined = plan(summarise.summarise(docs, "id", "text"))
    text_side = joined[: joined.rindex("SortMergeJoin")] if "SortMergeJoin" in joined else joined[: joined.rindex("BroadcastHashJoin")]
    assert "regexp_extract_all" in text_side
    tokens = chunking.tokenised(docs, "id", "text", carry=("text",))
    assert tokens.columns == ["id", "text", "tokens", "n_tokens", "n_chunks", "budget"]


def test_postings_are_segments_in_the_order_of_terms(spark, tmp_path):
    docs = texts(spark, 50)
    term_index.build_term_index(docs, str(tmp_path / "index"), "id", "text")
    postings = spark.read.parquet(str(tmp_path / "index" / "postings")).select("id", "term", "weight", F.col("_metadata.file_name").alias("f"))
    whole = tfidf.tfidf_l2(docs, "id", "text")
    left, right = (x.select("id", "term", F.round("weight", 9)) for x in (postings, whole))
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    files = {}
    for r in postings.collect():
        files.setdefault(r.f, []).append((r.term, r.id))
    assert len(files) > 1 and all(rows == sorted(rows) for rows in files.values())
    by_id = {}
    for f, rows in files.items():
        for _, i in rows:
            by_id.setdefault(i, set()).add(f)
    assert all(len(fs) == 1 for fs in by_id.values())  # a document's postings are not dealt out by term
