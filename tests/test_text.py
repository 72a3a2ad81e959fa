from __future__ import annotations

import re
import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from talkatlas.functions import text as T


def apply(spark, expression, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string")
    return [r.out for r in rows.select("id", expression(F.col("s")).alias("out")).orderBy("id").collect()]


def test_clean_transcript(spark):
    values = ["  Hello, WORLD 12 ", "\n\tab1\n", "123", "", None, "né a b", "[music] Hi"]
    assert apply(spark, T.clean_transcript, values) == ["hello world", "\n\tab\n", "", "", None, "n a b", "music hi"]
    assert apply(spark, lambda c: T.clean_transcript(c, drop_brackets=True), ["[a] b [c] d"]) == ["d"]
    assert apply(spark, lambda c: T.missing_if_empty(T.clean_transcript(c)), ["123", "a"]) == [None, "a"]


def test_number_strippers(spark):
    assert apply(spark, T.strip_street_numbers, ["12 Main 7 St 3 x"]) == ["Main St 3 x"]
    assert apply(spark, T.strip_level_numbers, ["Level 12 Level x"]) == ["Level  Level x"]
    assert apply(spark, T.strip_note_numbers, ["Note 3"]) == ["Note  "]
    assert apply(spark, T.strip_numbers_and_symbols, ["a 12 b", "x1y2!", "a\nb c"]) == ["a  b", "xy", "ab c"]
    assert apply(spark, T.newline_to_space, ["a\nb"]) == ["a b"]


def test_counts(spark):
    values = [" a b  c ", "", "x y", "\n", None]
    assert apply(spark, T.word_count, values) == [3, 0, 2, 0, None]
    assert apply(spark, T.token_count, ["It's a_b, é 12", ""]) == [5, 0]


def test_stop_words_and_replacements(spark):
    assert apply(spark, lambda c: T.remove_stop_words(c, ["the", "a"]), ["the cat a  the dog"]) == ["cat dog"]
    assert apply(spark, lambda c: T.replace_values(c, {"NlP": "NLP"}), ["NlP", "DL", None]) == ["NLP", "DL", None]


def clean_text_by_hand(s: str) -> str:
    """The described steps, one by one."""
    for c in string.punctuation:
        if c not in ".-":
            s = s.replace(c, " ") if s else s
    s = s.lower()
    s = " ".join(t for t in s.split(" ") if t.strip() != "")
    s = "".join(c for c in s if c in string.printable)
    if s in [f" {n} " for n in T.ROMAN_NUMERALS]:
        s = ""
    return re.sub(" +", " ", s.strip()).strip()


def test_clean_text(spark):
    values = ["Part II, End!", " é ii é ", "ii", "a \n b", "a\n b", "x - y.", "", " ", "é x y é", "a  \t  b"]
    assert apply(spark, T.clean_text, values) == [clean_text_by_hand(v) for v in values]
    assert apply(spark, lambda c: T.clean_text(c, drop_roman=True), ["Part ii end IX"]) == ["part end"]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB9 .,-!\n\t\x0b\x1c\x85  éİ", max_size=25), min_size=20, max_size=40))
def test_clean_text_property(spark, values):
    assert apply(spark, T.clean_text, values) == [clean_text_by_hand(v) for v in values]


@pytest.mark.parametrize("value", ["a b c", "  x  ", ""])
def test_words(spark, value):
    assert apply(spark, T.words, [value]) == [value.split()]
