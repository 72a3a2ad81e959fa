from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkatlas.operators import labels as L
from talkatlas.operators import profile as P
from talkatlas.operators import split as S
from talkatlas.operators.lemma import lemmatise, preprocess_column
from talkatlas.operators.ranking import global_rank, top_per_group
from talkatlas.operators.skew import skew_join
from talkatlas.session import scratch_path
from talkatlas.sources import files
from talkatlas.sources.vectors import parse_vectors


def transcripts_small(spark):
    rows = [
        (0, "a", "Hello, \"World\"\n2nd line", "p1"),
        (1, "b", None, "p1"),
        (2, "a", "", "p2"),
        (3, "c", "123", None),
        (4, "d", " é, x\ty ", "p2"),
        (5, "a", "[music] hi", "p1"),
    ]
    return spark.createDataFrame(rows, "row_ix long, title string, transcript string, playlist_name string")


def test_csv_keeps_quotes_lines_and_nulls(spark):
    df = transcripts_small(spark).where(F.col("transcript").isNull() | (F.col("transcript") != ""))
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    back = files.read_csv(spark, path, files.with_index(files.TRANSCRIPT_SCHEMA))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert back.drop(files.INDEX_COLUMN).columns == ["title", "transcript", "playlist_name"]


def test_csv_audit_returns_rows_that_do_not_fit(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("row_ix,title",), ("1,a",), ("x,b",)], "value string").coalesce(1).write.text(path)
    schema = T.StructType([T.StructField("row_ix", T.LongType()), T.StructField("title", T.StringType())])
    rows = files.read_csv(spark, path, schema, audit=True).cache()
    assert [r._corrupt_record for r in rows.where(F.col(files.REJECTED).isNotNull()).collect()] == ["x,b"]


def test_line_keys_follow_the_file_order(spark):
    lines = spark.range(0, 1000, numPartitions=5).select(F.format_string("%04d", "id").alias("line"))
    path = scratch_path(spark, "lines")
    files.write_lines(lines.orderBy("line"), "line", path)
    got = [r.value for r in files.read_lines(spark, path).orderBy("line_key").collect()]
    assert got == [f"{i:04d}" for i in range(1000)]


def test_parse_vectors_sorts_out_bad_rows(spark):
    rows = [
        (0, "[array([0.1, 0.2,\n 0., -1e-3],\n      dtype=float32)]"),
        (1, "[array([0.1, 0.2, 0.3],\n      dtype=float32)]"),
        (2, "[array([0.1, x, 0.3, 0.4], dtype=float32)]"),
        (3, ""),
        (4, None),
    ]
    good, bad = parse_vectors(spark.createDataFrame(rows, "id long, s string"), "s", 4)
    (row,) = good.collect()
    assert row.id == 0 and [round(x, 4) for x in row.embedding] == [0.1, 0.2, 0.0, -0.001]
    assert sorted(r.id for r in bad.collect()) == [1, 2, 3, 4]


def test_label_lines(spark):
    lines = [(0, "k1 ::: NlP"), (1, "  k2:::DL "), (2, "no separator"), (3, "a:::b:::c"), (4, "k1 ::: ML")]
    df = spark.createDataFrame(lines, "line_ix long, value string")
    parsed = {r.playlist_name: r.category for r in L.parse_label_lines(df, "value", "line_ix").collect()}
    assert parsed == {"k1": "ML", "k2": "DL"}
    assert sorted(r.line_ix for r in L.rejected_label_lines(df, "value").collect()) == [2, 3]


def test_profile_counts_nulls_empties_and_distincts(spark):
    got = {r.column_name: r for r in P.column_profile(
        transcripts_small(spark), ["title", "transcript", "playlist_name"], long_text=("transcript",)).collect()}
    assert (got["title"].n_distinct, got["title"].n_null) == (4, 0)
    assert (got["transcript"].n_null, got["transcript"].n_empty, got["transcript"].n_distinct) == (1, 1, 5)
    assert (got["playlist_name"].n_null, got["playlist_name"].n_distinct) == (1, 2)
    assert {r.n_rows for r in got.values()} == {6}


def test_top_share_adds_the_rest(spark):
    counts = spark.createDataFrame([(f"p{i}", i) for i in range(1, 8)], "name string, n long")
    rows = [(r.name, r.n, round(r.percentage, 4)) for r in P.top_share(counts, "name", "n", 2).collect()]
    assert rows == [("p7", 7, 25.0), ("p6", 6, 21.4286), ("others", 15, 53.5714)]
    assert [(r.name, r.n, r.percentage) for r in P.top_share(counts.limit(0), "name", "n").collect()] == [("others", 0, None)]


def test_global_rank_with_a_hot_value(spark):
    df = spark.range(0, 3000, numPartitions=7).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    ranked = global_rank(df, [F.desc("v"), F.asc("id")]).collect()
    expected = sorted(((r.id, r.v) for r in ranked), key=lambda p: (-p[1], p[0]))
    assert [(r.id, r.v) for r in sorted(ranked, key=lambda r: r["rank"])] == expected
    assert sorted(r["rank"] for r in ranked) == list(range(3000))


def test_top_per_group_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("g"))
    top = top_per_group(df, ["g"], [F.desc("id")], 3)
    assert sorted(r.id for r in top.collect()) == [94, 95, 96, 97, 98, 99]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_skew_join_keeps_every_row(spark):
    keys = [None] * 40 + ["hot"] * 400 + [f"k{i}" for i in range(100)] + ["lost"] * 3
    df = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    lookup = spark.createDataFrame([("hot", 1)] + [(f"k{i}", i) for i in range(100)], "key string, v long")
    for how in ("inner", "left"):
        got = skew_join(df, lookup, "key", how)
        plain = df.join(lookup, "key", how)
        assert sorted(map(str, got.select("id", "key", "v").collect())) == sorted(map(str, plain.select("id", "key", "v").collect()))


def test_skew_join_splits_a_hot_key_and_scans_once(spark, monkeypatch):
    """A key with 30 % of the rows is split into several tasks when the lookup is not broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 10 < 3, F.lit("hot")).otherwise(F.sha2(F.col("id").cast("string"), 256))
        pad = F.sha2(F.concat(F.lit("pad"), F.col("id").cast("string")), 256)
        df = spark.range(0, 60_000, 1, 8).select("id", hot.alias("key"), pad.alias("pad"))
        lookup = df.select("key").distinct().withColumn("v", F.length("key"))
        joined = skew_join(df, lookup, "key").withColumn("task", F.spark_partition_id())
        hot_rows = F.count_if(F.col("key") == "hot").alias("count")
        rows = [r for r in joined.groupBy("task").agg(hot_rows, F.max("pad")).collect() if r["count"]]
        assert sum(r["count"] for r in rows) == 18_000
        assert len(rows) > 1 and max(r["count"] for r in rows) < 18_000
        assert joined._jdf.queryExecution().sparkPlan().toString().count("Range (") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_category_codes_are_alphabetical_and_drop_null(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, None), (3, "c"), (4, "a")], "id long, category string")
    assert {r.id: r.label for r in L.category_codes(df, "category").collect()} == {0: 1.0, 1: 0.0, 3: 2.0, 4: 0.0}


def test_positional_rename_and_key_comparison(spark):
    df = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x"), (3, "z"), (4, None)], "id long, p string")
    names = spark.createDataFrame([(0, "first"), (1, "second")], "position long, name string")
    got = {r.id: r.new_name for r in L.positional_rename(df, "p", "id", names, "name", "position").collect()}
    assert got == {0: "first", 1: "second", 2: "first", 3: None, 4: None}
    a = spark.createDataFrame([(0, "u"), (1, "v")], "position long, k string")
    b = spark.createDataFrame([(1, "u"), (0, "v")], "position long, k string")
    assert L.same_keys(a, b, "k").first().equal is True
    assert L.same_keys(a, b, "k", "position").first().equal is False


def test_nulls_are_values_when_keys_are_compared(spark):
    a = spark.createDataFrame([("x",), (None,), (None,)], "k string")
    b = spark.createDataFrame([(None,), ("x",)], "k string")
    assert L.same_keys(a, b, "k").first().equal is True
    assert L.same_keys(a, b.where("k IS NOT NULL"), "k").first().equal is False
    assert L.values_not_in(a, b, "k").count() == 0
    assert [r.k for r in L.values_not_in(a, b.where("k IS NOT NULL"), "k").collect()] == [None]


def test_lines_keep_their_order_beyond_100000_files(spark, tmp_path):
    for name, line in (("part-99999-a.txt", "first"), ("part-100000-a.txt", "second"), ("part-1000000-a.txt", "third")):
        (tmp_path / name).write_text(line + "\n")
    lines = files.read_lines(spark, str(tmp_path)).orderBy("line_key")
    assert [r.value for r in lines.collect()] == ["first", "second", "third"]


def test_splits_are_complete_and_independent_of_partitions(spark):
    ids = spark.range(5000)
    train, test = S.train_test_split(ids, "id")
    assert train.count() + test.count() == 5000 and 3800 < train.count() < 4200
    assert {r.id for r in S.sample_rows(ids.repartition(1), "id", 7).collect()} == {
        r.id for r in S.sample_rows(ids.repartition(7), "id", 7).collect()
    }
    assert {r.fold for r in S.with_fold(ids, "id").select("fold").distinct().collect()} == set(range(5))
    parts = {r.part: r["count"] for r in S.split_at_row(ids, "id", 1234).groupBy("part").count().collect()}
    assert parts == {1: 1234, 2: 3766}
    assert S.split_at_row(ids, "id", 0).where("part = 1").count() == 0


def test_split_counts_repeated_and_missing_ids_as_rows(spark):
    ids = spark.createDataFrame([(None,), (1,), (1,), (1,), (2,), (3,)], "id long")
    for n, want in ((2, [1, 1]), (4, [1, 1, 1, 2]), (6, [1, 1, 1, 2, 3, None])):
        first = S.split_at_row(ids, "id", n).where("part = 1").collect()
        assert sorted((r.id for r in first), key=lambda x: (x is None, x)) == want
    parts = S.split_at_row(spark.range(500), "id", 123).groupBy("part").agg(F.count("*").alias("n"), F.max("id").alias("m"))
    assert {r.part: (r.n, r.m) for r in parts.collect()} == {1: (123, 122), 2: (377, 499)}


def test_lemmas_keep_order_and_unknown_words(spark):
    docs = spark.createDataFrame([(0, "cats the cats run"), (1, "the"), (2, ""), (3, None)], "id long, s string")
    lemmas = spark.createDataFrame([("cats", "cat"), ("the", "article")], "token string, lemma string")
    got = {r.id: r.lemmas for r in lemmatise(docs, "id", "s", lemmas, ["the"]).collect()}
    assert got == {0: "cat cat run", 1: "", 2: ""}
    done = preprocess_column(docs, "id", "s", lemmas, ["the", "run"]).collect()
    assert {r.id: r.processed_value for r in done} == {0: "cat cat", 1: "", 2: ""}
    plain = preprocess_column(docs, "id", "s").collect()
    assert {r.id: r.processed_value for r in plain} == {0: "cats the cats run", 1: "the", 2: ""}
