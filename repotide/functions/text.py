"""Text expressions: cleaning, cutting and joining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repotide.fixed import MISSING_TEXT, NON_LETTER_RUNS


def letters_only(text: Column) -> Column:
    """Drop every character that is neither a plain letter nor a space.

    The neighbours of a dropped character join up.
    """
    return F.regexp_replace(text, NON_LETTER_RUNS, "")


def tokens(text: Column, fold_case: bool = False) -> Column:
    """Cleaned text cut at each single space; neighbouring spaces give empty tokens."""
    cleaned = letters_only(text)
    return F.split(F.lower(cleaned) if fold_case else cleaned, " ")


def words(text: Column, fold_case: bool = False) -> Column:
    """Cleaned text cut at runs of spaces: an array without empty words."""
    return F.array_remove(tokens(text, fold_case), "")


def words_or_empty(text: Column) -> Column:
    """Words of a description, an empty array when there is no description."""
    return F.coalesce(words(text), F.array().cast("array<string>"))


def missing_to_null(text: Column) -> Column:
    """Read the captured text for a missing value back as null."""
    return F.nullif(text, F.lit(MISSING_TEXT))


def spread_characters(number: Column) -> Column:
    """The characters of an integer with commas between them; a sign counts as one."""
    return F.concat_ws(",", F.split(number.cast("string"), ""))


def split_commas(text: Column) -> Column:
    return F.split(text, ",")


def pairs_text(pairs: Column, first: str, second: str) -> Column:
    """``(a,1),(b,2)`` for an array of structs, in array order."""
    return F.array_join(
        F.transform(pairs, lambda p: F.format_string("(%s,%d)", p[first], p[second])), ","
    )
