"""Text expressions. All run on the JVM; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes, spelled out because the shorthand classes
# differ between regex engines.
WHITESPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"
WORD = r"[\p{L}\p{N}_]"

# The ASCII punctuation that becomes a space (all but dot and dash)
# and complements of the kept characters. Complements are spelled as ranges: the
# JVM matches a negated union of ranges about eight times slower.
PUNCTUATION = r"[!-,/:-@\[-`{-~]"
NOT_LETTER_OR_SPACE = r"[\x00-\x08\x0E-\x1F!-@\[-`{-\x{10FFFF}]"
NOT_ALPHANUMERIC_OR_BLANK = r"[\x00-\x1F!-/:-@\[-`{-\x{10FFFF}]"
ASCII_BLANKS = " \t\n\x0B\f\r"
NON_PRINTABLE = r"[\x00-\x08\x0E-\x1F\x7F-\x{10FFFF}]"

# Roman numerals handled by clean_text.
ROMAN_NUMERALS = ["ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x"]


def clean_transcript(c: Column, drop_brackets: bool = False) -> Column:
    """Letters and whitespace only, lower case, outer spaces trimmed."""
    if drop_brackets:
        c = F.regexp_replace(c, r"\[.*\]", "")
    return F.trim(F.lower(F.regexp_replace(c, NOT_LETTER_OR_SPACE, "")))


def missing_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def newline_to_space(c: Column) -> Column:
    return F.replace(c, F.lit("\n"), F.lit(" "))


def strip_street_numbers(c: Column) -> Column:
    """Drop a number and its space when a capital letter follows."""
    return F.regexp_replace(c, r"\p{Nd}+ ([A-Z])", "$1")


def strip_level_numbers(c: Column) -> Column:
    return F.regexp_replace(c, r"Level \p{Nd}+", "Level ")


def strip_note_numbers(c: Column) -> Column:
    """Leaves two spaces after ``Note``."""
    return F.regexp_replace(c, r"Note \p{Nd}+", "Note  ")


def clean_text(c: Column, drop_roman: bool = False) -> Column:
    """Lower case, punctuation to spaces, printable ASCII only, single spaces.

    By default a Roman numeral stays unless it is, with one space on either
    side, the whole text; ``drop_roman`` drops every token that is one.
    """
    spaced = F.regexp_replace(F.lower(c), PUNCTUATION, " ")
    no_blank_tokens = F.regexp_replace(spaced, rf"(?<![^ ])[{WHITESPACE}&&[^ ]]+(?![^ ])", "")
    single_spaced = F.trim(F.regexp_replace(no_blank_tokens, " {2,}", " "))
    ascii_only = F.regexp_replace(single_spaced, NON_PRINTABLE, "")
    if drop_roman:
        kept = F.filter(F.split(ascii_only, " "), lambda w: ~w.isin(ROMAN_NUMERALS))
        ascii_only = F.array_join(kept, " ")
    else:
        # One pattern and no CASE, which would evaluate the whole chain twice.
        ascii_only = F.regexp_replace(ascii_only, rf"\A (?:{'|'.join(ROMAN_NUMERALS)}) \z", "")
    trimmed = F.trim(ascii_only, F.lit(ASCII_BLANKS))
    return F.regexp_replace(trimmed, " {2,}", " ")


def strip_numbers_and_symbols(c: Column) -> Column:
    """Keep ASCII letters, digits and spaces, then delete digits inside each token.

    A token made of digits becomes empty but keeps its place, so two spaces
    stay around it.
    """
    kept = F.regexp_replace(c, NOT_ALPHANUMERIC_OR_BLANK, "")
    tokens = F.filter(F.split(kept, " "), lambda t: t != "")
    return F.array_join(F.transform(tokens, lambda t: F.regexp_replace(t, "[0-9]", "")), " ")


def words(c: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.regexp_extract_all(c, F.lit(rf"[^{WHITESPACE}]+"), F.lit(0))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"[^{WHITESPACE}]+")).cast("bigint")


def tokens(c: Column) -> Column:
    """Lower-case runs of letters, digits and underscore."""
    return F.regexp_extract_all(F.lower(c), F.lit(rf"{WORD}+"), F.lit(0))


def token_count(c: Column) -> Column:
    return F.regexp_count(F.lower(c), F.lit(rf"{WORD}+")).cast("bigint")


def remove_stop_words(c: Column, stop_words: list[str]) -> Column:
    stop = F.array(*[F.lit(w) for w in stop_words])
    return F.array_join(F.filter(words(c), lambda w: ~F.array_contains(stop, w)), " ")


def replace_values(c: Column, changes: dict[str, str]) -> Column:
    """Exact-value replacement, for example a misspelt category."""
    for old, new in changes.items():
        c = F.when(c == old, F.lit(new)).otherwise(c)
    return c
