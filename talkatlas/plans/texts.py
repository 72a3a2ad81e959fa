"""Registered queries: text cleaning, stop words, lemmas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkatlas.functions import text as TX
from talkatlas.operators import lemma
from talkatlas.plans.common import PARTLY_MISSING, TRANSCRIPTS, Query, partly_missing, spread_transcripts
from talkatlas.session import cut

# The stop words of the registered queries, a few per language.
STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "der", "die", "und", "la", "le", "les", "el", "de", "que"]
_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"


def _text(expression: Column, spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_transcripts(spark, sf_dir).select("doc_id", expression.alias("text"))


def _prefixed(*parts: str | Column) -> Column:
    """The transcript behind a marker made from the row's own columns."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts], F.col("transcript"))


def clean_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = TX.missing_if_empty(TX.clean_transcript(F.col("transcript")))
    return spread_transcripts(spark, sf_dir).select("title", "transcript", "playlist_name", "doc_id").withColumn("transcript", cleaned)


def clean_drop_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = _prefixed("[", F.col("playlist_name"), "] ")
    return _text(TX.clean_transcript(marked, drop_brackets=True), spark, sf_dir)


def newline_to_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.newline_to_space(F.col("transcript")), spark, sf_dir)


def strip_street_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.strip_street_numbers(_prefixed(F.col("doc_id").cast("string"), " ")), spark, sf_dir)


def strip_level_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id").cast("string")
    marked = _prefixed("Level ", number, " Note ", number, " ")
    return _text(TX.strip_note_numbers(TX.strip_level_numbers(marked)), spark, sf_dir)


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.clean_text(F.col("transcript")), spark, sf_dir)


def clean_text_roman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.clean_text(_prefixed("Part ii of ", F.col("title"), ", IX. v: "), drop_roman=True), spark, sf_dir)


def strip_num_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.strip_numbers_and_symbols(_prefixed(F.col("title"), " x")), spark, sf_dir)


def remove_stop_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(TX.remove_stop_words(F.col("transcript"), STOP_WORDS), spark, sf_dir)


def _lemma_table(docs: DataFrame, text: str) -> DataFrame:
    """A lemma table from the corpus itself: a word in -s whose stem also occurs."""
    words = cut(docs.select(F.explode_outer(TX.words(F.col(text))).alias("token")).dropna().distinct())
    stems = words.select(F.concat("token", F.lit("s")).alias("token"), F.col("token").alias("lemma"))
    return words.where(F.length("token") > 3).join(stems, "token")


def lemma_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cut(_text(TX.clean_text(F.col("transcript")), spark, sf_dir).withColumnRenamed("text", "cleaned"))
    return lemma.lemmatise(docs, "doc_id", "cleaned", _lemma_table(docs, "cleaned"), STOP_WORDS)


def preprocess_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = partly_missing(spark, sf_dir)
    cleaned = docs.dropna(subset=["transcript"]).select(TX.clean_text(F.col("transcript")).alias("cleaned"))
    done = lemma.preprocess_column(docs, "doc_id", "transcript", _lemma_table(cleaned, "cleaned"), STOP_WORDS)
    return done.select("doc_id", "title", "processed_value")


# --- SQL twins -------------------------------------------------------------------

_WS = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
# ASCII punctuation without dot and dash.
_PUNCT = "!\"#$%&''()*+,/:;<=>?@[\\]^_`{|}~"
_ROMAN = ", ".join(f"'{n}'" for n in TX.ROMAN_NUMERALS)
_ROMAN_PADDED = ", ".join(f"' {n} '" for n in TX.ROMAN_NUMERALS)


def _clean_transcript_sql(x: str) -> str:
    return rf"trim(lower(regexp_replace({x}, '[^a-zA-Z\s\x0B]', '', 'g')))"


def clean_text_sql(x: str, drop_roman: bool = False) -> str:
    spaced = f"translate(lower({x}), '{_PUNCT}', '{' ' * 30}')"
    words = f"list_filter(string_split({spaced}, ' '), lambda w: NOT regexp_full_match(w, '[{_WS}]*'))"
    ascii_only = rf"regexp_replace(array_to_string({words}, ' '), '[^\x09-\x0D\x20-\x7E]', '', 'g')"
    if drop_roman:
        ascii_only = f"array_to_string(list_filter(string_split({ascii_only}, ' '), lambda w: w NOT IN ({_ROMAN})), ' ')"
    else:
        ascii_only = f"CASE WHEN {ascii_only} IN ({_ROMAN_PADDED}) THEN '' ELSE {ascii_only} END"
    trimmed = rf"regexp_replace({ascii_only}, '^[\s\x0B]+|[\s\x0B]+$', '', 'g')"
    return f"regexp_replace({trimmed}, ' +', ' ', 'g')"


def _select(x: str) -> str:
    return f"SELECT doc_id, {x} AS text FROM {TRANSCRIPTS}"


def _words_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{_WS}]+')"


def _stop_sql(x: str) -> str:
    return f"array_to_string(list_filter({_words_sql(x)}, lambda w: NOT list_contains({_STOP_SQL}, w)), ' ')"


def _lemma_sql(source: str) -> str:
    return rf"""docs AS (SELECT doc_id, title, {_words_sql(clean_text_sql('transcript'))} AS ws FROM {source}
        WHERE transcript IS NOT NULL),
      w AS (SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS token FROM docs),
      vocab AS (SELECT DISTINCT token FROM w),
      lemmas AS (SELECT a.token, b.token AS lemma FROM vocab a JOIN vocab b ON a.token = b.token || 's'
        WHERE length(a.token) > 3),
      done AS (SELECT doc_id, string_agg(coalesce(lemma, w.token), ' ' ORDER BY pos) AS lemmas
        FROM w LEFT JOIN lemmas ON w.token = lemmas.token
        WHERE NOT list_contains({_STOP_SQL}, w.token) GROUP BY doc_id),
      lemmatised AS (SELECT docs.doc_id, docs.title, coalesce(lemmas, '') AS lemmas
        FROM docs LEFT JOIN done ON docs.doc_id = done.doc_id)"""


QUERIES: dict[str, Query] = {
    "clean_transcripts": Query(
        clean_transcripts,
        f"""SELECT doc_id, title, nullif({_clean_transcript_sql('transcript')}, '') AS transcript, playlist_name
        FROM {TRANSCRIPTS}""",
    ),
    "clean_drop_brackets": Query(
        clean_drop_brackets,
        _select(
            _clean_transcript_sql(r"regexp_replace('[' || playlist_name || '] ' || transcript, '\[.*\]', '', 'g')")
        ),
    ),
    "newline_to_space": Query(newline_to_space, _select("replace(transcript, chr(10), ' ')")),
    "strip_street_numbers": Query(
        strip_street_numbers,
        _select(r"regexp_replace(doc_id || ' ' || transcript, '(?:\p{Nd}+ )([A-Z])', '\1', 'g')"),
    ),
    "strip_level_note": Query(
        strip_level_note,
        _select(
            r"""regexp_replace(regexp_replace('Level ' || doc_id || ' Note ' || doc_id || ' ' || transcript,
            'Level \p{Nd}+', 'Level ', 'g'), 'Note \p{Nd}+', 'Note  ', 'g')"""
        ),
    ),
    "clean_text": Query(clean_text, _select(clean_text_sql("transcript"))),
    "clean_text_roman": Query(
        clean_text_roman,
        _select(clean_text_sql("('Part ii of ' || title || ', IX. v: ' || transcript)", drop_roman=True)),
    ),
    "strip_num_special": Query(
        strip_num_special,
        _select(
            """array_to_string(list_transform(list_filter(string_split(
            regexp_replace(title || ' x' || transcript, '[^a-zA-Z0-9 ]', '', 'g'), ' '), lambda t: t <> ''),
            lambda t: regexp_replace(t, '[0-9]', '', 'g')), ' ')"""
        ),
    ),
    "remove_stop_words": Query(remove_stop_words, _select(_stop_sql("transcript"))),
    "lemma_lookup": Query(lemma_lookup, f"WITH {_lemma_sql(TRANSCRIPTS)} SELECT doc_id, lemmas FROM lemmatised"),
    "preprocess_column": Query(
        preprocess_column,
        f"""WITH {_lemma_sql(PARTLY_MISSING)}
        SELECT doc_id, title, {_stop_sql('lemmas')} AS processed_value FROM lemmatised""",
    ),
}
