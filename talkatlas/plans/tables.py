"""Registered queries: files, projections, profiles, labels, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.functions import text as TX
from talkatlas.functions.sampling import fold, is_train
from talkatlas.operators import labels as L
from talkatlas.operators import profile as P
from talkatlas.operators import sketches as K
from talkatlas.operators import split as S
from talkatlas.plans.common import PARTLY_MISSING, TRANSCRIPTS, Query, partly_missing, spread_transcripts, table, transcripts
from talkatlas.session import scratch_path
from talkatlas.sources import files
from talkatlas.sources.split_csv import read_csv_split

# --- files -----------------------------------------------------------------


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "transcripts-csv")
    indexed = transcripts(spark, sf_dir).withColumnRenamed("doc_id", files.INDEX_COLUMN).drop("category")
    files.write_csv(indexed, path)
    return files.read_csv(spark, path, files.with_index(files.TRANSCRIPT_SCHEMA))


def csv_split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of ``csv_roundtrip``, each read by as many tasks as it has splits."""
    path = scratch_path(spark, "transcripts-csv")
    indexed = transcripts(spark, sf_dir).withColumnRenamed("doc_id", files.INDEX_COLUMN).drop("category")
    files.write_csv(indexed, path)
    return read_csv_split(spark, path, files.with_index(files.TRANSCRIPT_SCHEMA))


def _label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label line per document: English lines lack the separator, German ones have two."""
    key = F.concat_ws("/", "playlist_name", "category")
    good = F.concat(F.lit("  "), key, F.lit(" ::: "), "category", F.lit(" "), "title")
    value = (
        F.when(F.col("category") == "en", F.concat(key, F.lit(" : "), "category"))
        .when(F.col("category") == "de", F.concat(key, F.lit(":::"), "category", F.lit(":::"), "title"))
        .otherwise(good)
    )
    return transcripts(spark, sf_dir).select(F.col("doc_id").alias("line_ix"), value.alias("value"))


_LINES = f"""lines AS (
  SELECT doc_id AS line_ix, string_split(value, ':::') AS parts, value FROM (
    SELECT doc_id, CASE category
      WHEN 'en' THEN playlist_name || '/' || category || ' : ' || category
      WHEN 'de' THEN playlist_name || '/' || category || ':::' || category || ':::' || title
      ELSE '  ' || playlist_name || '/' || category || ' ::: ' || category || ' ' || title END AS value
    FROM {TRANSCRIPTS}))"""
_LABEL_MAP = f"""{_LINES}, label_map AS (
  SELECT trim(parts[1]) AS playlist_name, max_by(trim(parts[2]), line_ix) AS category
  FROM lines WHERE len(parts) = 2 GROUP BY 1)"""


def label_map_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.parse_label_lines(_label_lines(spark, sf_dir), "value", "line_ix")


def label_map_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.rejected_label_lines(_label_lines(spark, sf_dir), "value")


def label_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label lines written as text files in order, read back and parsed."""
    path = scratch_path(spark, "label-lines")
    files.write_lines(_label_lines(spark, sf_dir).orderBy("line_ix"), "value", path)
    return L.parse_label_lines(files.read_lines(spark, path), "value", "line_key")


# --- projections and filters -------------------------------------------------


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws("/", "playlist_name", "category")
    return transcripts(spark, sf_dir).select("doc_id", key.alias("playlist_name"))


_KEYED = f"(SELECT doc_id, playlist_name || '/' || category AS playlist_name FROM {TRANSCRIPTS})"


def drop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partly_missing(spark, sf_dir).dropna(subset=["transcript"]).select("doc_id", "title", "transcript")


def missing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partly_missing(spark, sf_dir).where(F.col("transcript").isNull()).select("doc_id", "title", "playlist_name")


def doc_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(spark, sf_dir).where(F.col("doc_id") == 8)


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(spark, sf_dir).orderBy("doc_id").limit(5)


def split_at_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_at_row(transcripts(spark, sf_dir).select("doc_id", "title"), "doc_id", 500)


def sample_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sample_rows(transcripts(spark, sf_dir), "doc_id", 10)


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(spark, sf_dir).select("doc_id", is_train(F.col("doc_id")).alias("is_train"))


def fold_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(spark, sf_dir).select("doc_id", fold(F.col("doc_id"), 5).alias("fold"))


def bucket_sql(row_id: str, buckets: int, seed: int) -> str:
    return f"('0x' || substr(md5('{seed}:' || {row_id}), 1, 8))::BIGINT % {buckets}"


# --- profile -----------------------------------------------------------------

_PROFILED = ["title", "transcript", "playlist_name", "category"]


def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.column_profile(partly_missing(spark, sf_dir), _PROFILED, long_text=("transcript",))


_COLUMN_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, 'string' AS data_type, count(*) AS n_rows,
      count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) FILTER (WHERE {c} = '') AS n_empty,
      count(DISTINCT {c}) AS n_distinct FROM {PARTLY_MISSING}"""
    for c in _PROFILED
)


def column_profile_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile merged from sketches of four parts, each stored by itself; counts up to 65,536 are exact."""
    path, bits = scratch_path(spark, "sketches"), 16
    parts = partly_missing(spark, sf_dir).withColumn("part", fold(F.col("doc_id"), 4))
    K.store_sketches(K.distinct_sketches(parts, _PROFILED, ("part",), bits), path, "part")
    merged = K.counted(K.merge(K.stored_sketches(spark, path), bits=bits))
    return merged.withColumn("data_type", F.lit("string"))


def row_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = partly_missing(spark, sf_dir)
    return P.row_loss(docs, docs.dropna(subset=["transcript"]))


def playlist_title_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = P.distinct_count_per_group(transcripts(spark, sf_dir), "playlist_name", "title")
    return counts.orderBy(F.desc("title_count"), "playlist_name")


_TITLE_COUNT = f"""SELECT playlist_name, count(DISTINCT title) AS title_count FROM {TRANSCRIPTS} GROUP BY 1"""


def playlist_title_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct titles per playlist, merged from stored sketches of its categories; beyond 4,096 titles an estimate."""
    path = scratch_path(spark, "sketches")
    sketches = K.distinct_sketches(transcripts(spark, sf_dir), ["title"], ("category", "playlist_name"))
    K.store_sketches(sketches, path, "category")
    merged = K.counted(K.merge(K.stored_sketches(spark, path), ("playlist_name",)))
    return merged.select("playlist_name", F.col("n_distinct").alias("title_count"))


def playlist_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return playlist_title_count(spark, sf_dir).limit(5)


def playlist_top5_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = P.distinct_count_per_group(transcripts(spark, sf_dir), "playlist_name", "title")
    return P.top_share(counts, "playlist_name", "title_count").withColumn("percentage", F.round("percentage", 6))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.value_counts(transcripts(spark, sf_dir), "category").orderBy(F.desc("n_rows"), "category")


def playlist_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = P.value_counts(transcripts(spark, sf_dir), "playlist_name")
    best = F.struct(-F.col("n_rows"), F.col("playlist_name"))
    return counts.agg(F.min_by("playlist_name", best).alias("playlist_name"), F.max("n_rows").alias("n_rows"))


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_transcripts(spark, sf_dir).select("doc_id", TX.word_count(F.col("transcript")).alias("n_words"))


def _token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_transcripts(spark, sf_dir).select("doc_id", TX.token_count(F.col("transcript")).alias("n_tokens"))


WORDS_SQL = r"len(regexp_extract_all(transcript, '[^\s\x0B\x1C-\x1F\x{85}\p{Z}]+'))"
TOKENS_SQL = r"len(regexp_extract_all(lower(transcript), '[\p{L}\p{N}_]+'))"


def word_count_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = P.number_stats(_word_counts(spark, sf_dir), "n_words")
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


def word_count_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rank_curve(_word_counts(spark, sf_dir), "doc_id", "n_words")


def token_count_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rank_curve(_token_counts(spark, sf_dir), "doc_id", "n_tokens")


def playlist_size_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = P.value_counts(transcripts(spark, sf_dir), "playlist_name")
    return P.rank_curve(sizes, "playlist_name", "n_rows")


def shortest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = transcripts(spark, sf_dir).select("doc_id", F.length("transcript").cast("bigint").alias("n_chars"))
    order = F.struct("n_chars", "doc_id")
    return sized.agg(F.min_by("doc_id", order).alias("doc_id"), F.min("n_chars").alias("n_chars"))


# --- labels and lookups --------------------------------------------------------


def attach_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("bigint").alias("quality"))
    return transcripts(spark, sf_dir).select("doc_id", "title").join(quality, "doc_id")


def concat_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables side by side by row, rows of either kept."""
    left = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("row_ix"), "text")
    right = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_ix"), F.col("quality").cast("bigint").alias("quality")
    )
    return left.join(right, "row_ix", "full")


def map_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.map_category(_keyed(spark, sf_dir), label_map_parse(spark, sf_dir))


def map_category_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.unmatched_keys(_keyed(spark, sf_dir), label_map_parse(spark, sf_dir))


def positional_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Playlists renamed by position to the label map's keys in order of first appearance."""
    lines = _label_lines(spark, sf_dir)
    parts = F.split("value", ":::")
    keys = lines.where(F.size(parts) == 2).select("line_ix", F.trim(parts[0]).alias("name"))
    names = L.first_seen_order(keys, "name", "line_ix")
    docs = transcripts(spark, sf_dir).select("doc_id", "playlist_name")
    return L.positional_rename(docs, "playlist_name", "doc_id", names, "name", "position")


def playlist_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of the whole table that no labelled document has."""
    docs = transcripts(spark, sf_dir).select("doc_id", "title")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return L.values_not_in(docs, labelled, "title")


def key_set_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Do labelled documents cover all playlists, as a set and in order of first appearance?"""
    docs = transcripts(spark, sf_dir).select("doc_id", "playlist_name")
    labelled = docs.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    as_set = L.same_keys(docs, labelled, "playlist_name").select(F.lit("set").alias("kind"), "equal")
    left = L.first_seen_order(docs, "playlist_name", "doc_id")
    right = L.first_seen_order(labelled, "playlist_name", "doc_id")
    ordered = L.same_keys(left, right, "playlist_name", "position").select(F.lit("ordered").alias("kind"), "equal")
    return as_set.unionByName(ordered)


_LABELLED = f"(SELECT * FROM {TRANSCRIPTS} WHERE doc_id IN (SELECT doc_id FROM labels))"


def _first_seen_sql(source: str) -> str:
    return f"""(SELECT playlist_name, row_number() OVER (ORDER BY min(doc_id)) AS position
      FROM {source} GROUP BY playlist_name)"""


def category_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.category_codes(transcripts(spark, sf_dir).select("doc_id", "category"), "category")


def normalise_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    fixed = TX.replace_values(F.col("category"), {"en": "EN", "fr": "FR"})
    return transcripts(spark, sf_dir).select("doc_id", fixed.alias("category"))


def playlist_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts(spark, sf_dir).select("playlist_name").distinct()


def concat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text")
    return docs.unionByName(items)


_INDEXED = f"SELECT doc_id AS row_ix, title, transcript, playlist_name FROM {TRANSCRIPTS}"

QUERIES: dict[str, Query] = {
    "csv_roundtrip": Query(csv_roundtrip, _INDEXED),
    "csv_split_roundtrip": Query(csv_split_roundtrip, _INDEXED),
    "label_map_parse": Query(label_map_parse, f"WITH {_LABEL_MAP} SELECT * FROM label_map"),
    "label_map_rejects": Query(
        label_map_rejects, f"WITH {_LINES} SELECT line_ix, value FROM lines WHERE len(parts) <> 2"
    ),
    "label_file_roundtrip": Query(label_file_roundtrip, f"WITH {_LABEL_MAP} SELECT * FROM label_map"),
    "drop_missing": Query(
        drop_missing, f"SELECT doc_id, title, transcript FROM {PARTLY_MISSING} WHERE transcript IS NOT NULL"
    ),
    "missing_rows": Query(
        missing_rows, f"SELECT doc_id, title, playlist_name FROM {PARTLY_MISSING} WHERE transcript IS NULL"
    ),
    "doc_lookup": Query(doc_lookup, f"SELECT * FROM {TRANSCRIPTS} WHERE doc_id = 8"),
    "preview_rows": Query(preview_rows, f"SELECT * FROM {TRANSCRIPTS} ORDER BY doc_id LIMIT 5"),
    "split_at_row": Query(
        split_at_row,
        f"""SELECT doc_id, title, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 500 THEN 1 ELSE 2 END::BIGINT AS part
        FROM {TRANSCRIPTS}""",
    ),
    "sample_k": Query(sample_k, f"SELECT * FROM {TRANSCRIPTS} ORDER BY md5('42:' || doc_id), doc_id LIMIT 10"),
    "train_test_split": Query(
        train_test_split, f"SELECT doc_id, {bucket_sql('doc_id', 10, 42)} < 8 AS is_train FROM documents"
    ),
    "fold_assign": Query(fold_assign, f"SELECT doc_id, {bucket_sql('doc_id', 5, 7)} AS fold FROM documents"),
    "column_profile": Query(column_profile, _COLUMN_PROFILE),
    "column_profile_sketched": Query(column_profile_sketched, _COLUMN_PROFILE),
    "row_loss": Query(
        row_loss,
        f"""SELECT count(*) AS rows_before, count(transcript) AS rows_after, count(*) - count(transcript) AS rows_lost
        FROM {PARTLY_MISSING}""",
    ),
    "playlist_title_count": Query(playlist_title_count, _TITLE_COUNT),
    "playlist_title_sketch": Query(playlist_title_sketch, _TITLE_COUNT),
    "playlist_top5": Query(playlist_top5, f"{_TITLE_COUNT} ORDER BY title_count DESC, playlist_name LIMIT 5"),
    "playlist_top5_share": Query(
        playlist_top5_share,
        f"""WITH c AS ({_TITLE_COUNT}),
        r AS (SELECT *, row_number() OVER (ORDER BY title_count DESC, playlist_name) AS rn FROM c)
        SELECT CASE WHEN rn <= 5 THEN playlist_name ELSE 'others' END AS playlist_name,
          sum(title_count)::BIGINT AS title_count,
          round(sum(title_count) * 100.0::DOUBLE / (SELECT sum(title_count) FROM c), 6)::DOUBLE AS percentage
        FROM r GROUP BY 1""",
    ),
    "category_counts": Query(
        category_counts, f"SELECT category, count(*) AS n_rows FROM {TRANSCRIPTS} WHERE category IS NOT NULL GROUP BY 1"
    ),
    "playlist_mode": Query(
        playlist_mode,
        f"""SELECT playlist_name, count(*) AS n_rows FROM {TRANSCRIPTS} WHERE playlist_name IS NOT NULL
        GROUP BY 1 ORDER BY n_rows DESC, playlist_name LIMIT 1""",
    ),
    "word_counts": Query(_word_counts, f"SELECT doc_id, {WORDS_SQL}::BIGINT AS n_words FROM {TRANSCRIPTS}"),
    "token_counts": Query(_token_counts, f"SELECT doc_id, {TOKENS_SQL}::BIGINT AS n_tokens FROM {TRANSCRIPTS}"),
    "word_count_stats": Query(
        word_count_stats,
        f"""SELECT count(n) AS n_rows, round(avg(n), 6) AS mean, max(n) AS max, min(n) AS min,
          round(stddev_samp(n), 6) AS std FROM (SELECT {WORDS_SQL}::BIGINT AS n FROM {TRANSCRIPTS})""",
    ),
    "word_count_curve": Query(
        word_count_curve,
        f"""SELECT doc_id, n_words, row_number() OVER (ORDER BY n_words DESC, doc_id) - 1 AS rank
        FROM (SELECT doc_id, {WORDS_SQL}::BIGINT AS n_words FROM {TRANSCRIPTS})""",
    ),
    "token_count_curve": Query(
        token_count_curve,
        f"""SELECT doc_id, n_tokens, row_number() OVER (ORDER BY n_tokens DESC, doc_id) - 1 AS rank
        FROM (SELECT doc_id, {TOKENS_SQL}::BIGINT AS n_tokens FROM {TRANSCRIPTS})""",
    ),
    "playlist_size_curve": Query(
        playlist_size_curve,
        f"""SELECT playlist_name, n_rows, row_number() OVER (ORDER BY n_rows DESC, playlist_name) - 1 AS rank
        FROM (SELECT playlist_name, count(*) AS n_rows FROM {TRANSCRIPTS} GROUP BY 1)""",
    ),
    "shortest_summary": Query(
        shortest_summary,
        f"""SELECT doc_id, length(transcript)::BIGINT AS n_chars FROM {TRANSCRIPTS}
        ORDER BY length(transcript), doc_id LIMIT 1""",
    ),
    "attach_category": Query(
        attach_category,
        f"SELECT doc_id, title, quality::BIGINT AS quality FROM {TRANSCRIPTS} JOIN labels USING (doc_id)",
    ),
    "concat_columns": Query(
        concat_columns,
        """SELECT coalesce(item_id, doc_id) AS row_ix, text, quality::BIGINT AS quality
        FROM benchmark FULL JOIN labels ON item_id = doc_id""",
    ),
    "map_category": Query(
        map_category,
        f"""WITH {_LABEL_MAP} SELECT doc_id, k.playlist_name, m.category
        FROM {_KEYED} k LEFT JOIN label_map m ON k.playlist_name = m.playlist_name""",
    ),
    "map_category_unmatched": Query(
        map_category_unmatched,
        f"""WITH {_LABEL_MAP} SELECT playlist_name, count(*) AS n_rows FROM {_KEYED}
        WHERE playlist_name NOT IN (SELECT playlist_name FROM label_map) GROUP BY 1""",
    ),
    "positional_rename": Query(
        positional_rename,
        f"""WITH {_LINES}, names AS (
          SELECT trim(parts[1]) AS new_name, row_number() OVER (ORDER BY min(line_ix)) AS position
          FROM lines WHERE len(parts) = 2 GROUP BY 1)
        SELECT doc_id, t.playlist_name, new_name FROM {TRANSCRIPTS} t
        JOIN {_first_seen_sql(TRANSCRIPTS)} p ON t.playlist_name = p.playlist_name
        LEFT JOIN names ON names.position = p.position""",
    ),
    "playlist_residual": Query(
        playlist_residual,
        f"SELECT DISTINCT title FROM {TRANSCRIPTS} WHERE title NOT IN (SELECT title FROM {_LABELLED})",
    ),
    "key_set_equal": Query(
        key_set_equal,
        f"""SELECT 'set' AS kind, bool_and(a.playlist_name IS NOT NULL AND b.playlist_name IS NOT NULL) AS equal
        FROM (SELECT DISTINCT playlist_name FROM {TRANSCRIPTS}) a
        FULL JOIN (SELECT DISTINCT playlist_name FROM {_LABELLED}) b ON a.playlist_name = b.playlist_name
        UNION ALL
        SELECT 'ordered', bool_and(a.playlist_name IS NOT NULL AND b.playlist_name IS NOT NULL)
        FROM {_first_seen_sql(TRANSCRIPTS)} a FULL JOIN {_first_seen_sql(_LABELLED)} b
        ON a.playlist_name = b.playlist_name AND a.position = b.position""",
    ),
    "category_codes": Query(
        category_codes,
        f"""SELECT doc_id, category, (dense_rank() OVER (ORDER BY category) - 1)::DOUBLE AS label
        FROM {TRANSCRIPTS} WHERE category IS NOT NULL""",
    ),
    "normalise_category": Query(
        normalise_category,
        f"""SELECT doc_id, CASE category WHEN 'en' THEN 'EN' WHEN 'fr' THEN 'FR' ELSE category END AS category
        FROM {TRANSCRIPTS}""",
    ),
    "playlist_distinct": Query(playlist_distinct, f"SELECT DISTINCT playlist_name FROM {TRANSCRIPTS}"),
    "concat_rows": Query(
        concat_rows,
        """SELECT 'documents' AS origin, doc_id AS id, text FROM documents
        UNION ALL SELECT 'benchmark', item_id, text FROM benchmark""",
    ),
}
