"""Name and token normalisation (PRJ03, FN01-FN05, MAT03)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole words read as their long form in every match key.
SAINT_WORDS = {"STO": "SANTO", "STA": "SANTA", "ST": "SAINT"}
SUPERSCRIPT_DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹"


def standardize(col: Column) -> Column:
    """Trim, upper-case and collapse whitespace."""
    return F.regexp_replace(F.upper(F.trim(col)), r"\s+", " ")


def tokens(col: Column, separator: str = ",") -> Column:
    """Sorted distinct trimmed tokens of a delimited list; never NULL."""
    parts = F.split(F.coalesce(col, F.lit("")), separator)
    return F.array_sort(
        F.array_distinct(F.filter(F.transform(parts, lambda part: F.trim(part)), lambda token: token != ""))
    )


def strip_stars(col: Column) -> Column:
    """The text without stars at its end and the blanks before them."""
    star = F.lit("*")
    return F.when(col.endswith("*"), F.rtrim(F.rtrim(col, star))).otherwise(col)


def strip_footnote(col: Column) -> Column:
    """The name without a trailing '*' and a trailing footnote number; NULL when nothing is left."""
    bare = F.regexp_replace(strip_stars(col), r"\s*[0-9]+$", "")
    return F.when(bare != "", bare)


def long_form(words: Mapping[str, str]):
    """A function that looks one word up, with or without a full stop behind it."""
    table = F.create_map(*[F.lit(text) for pair in words.items() for text in pair])

    def full(word: Column) -> Column:
        stem = F.when(word.endswith("."), F.substring(word, F.lit(1), F.length(word) - 1))
        return F.coalesce(F.try_element_at(table, word), F.try_element_at(table, stem), word)

    return full


def expand_words(col: Column, words: Mapping[str, str] = SAINT_WORDS) -> Column:
    """Replace whole words that stand in the table; repeated abbreviations are all expanded."""
    return F.array_join(F.transform(F.split(F.trim(col), " "), long_form(words)), " ")


def is_letter(char: Column) -> Column:
    return char.rlike(r"\p{L}")


def join_words(words: Column) -> Column:
    """Words in a row; a blank stays only where a letter is missing on one of its sides."""

    def add(done: Column, word: Column) -> Column:
        close = is_letter(F.right(done, F.lit(1))) & is_letter(F.left(word, F.lit(1)))
        return F.concat(done, F.when(close, "").otherwise(" "), word)

    return F.aggregate(F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), F.element_at(words, 1), add)


def match_key(col: Column, words: Mapping[str, str] = SAINT_WORDS) -> Column:
    """One key for two vocabularies: footnote marks gone, words in their long form, letters together.

    A hyphen, a blank between two letters and no separator are the same name.
    """
    name = strip_stars(F.trim(F.translate(col, SUPERSCRIPT_DIGITS, "")))
    full = long_form(words)
    return join_words(F.transform(F.split(name, r"\s+"), lambda word: F.translate(full(word), "-", "")))


def short_label(col: Column) -> Column:
    """The text inside trailing parentheses, else the whole text."""
    inside = F.regexp_extract(col, r"\(([^()]+)\)\s*$", 1)
    return F.when(inside != "", F.trim(inside)).otherwise(F.trim(col))


def unquote_numbers(col: Column) -> Column:
    """JSON text whose quoted numbers and quoted lists stand without quotes.

    Escaped characters are put aside first, so that every quote left begins or ends a string, and
    put back at the end: cut at the quotes, every second part is the inside of a string. A string
    with an escape in it is no number and keeps its quotes. Text with an open string stays.
    """
    marked = F.regexp_replace(col, r"\\(.)", "\ue000$1\ue001")
    aside = F.replace(marked, F.lit('\ue000"\ue001'), F.lit("\ue002"))
    parts = F.split(aside, '"')

    def is_number(part: Column) -> Column:
        only = F.translate(part, "0123456789.eE+-", "") == ""
        ends = F.ltrim(part, F.lit("-")).substr(1, 1).between("0", "9") & F.right(part, F.lit(1)).between("0", "9")
        return only & ends & part.try_cast("double").isNotNull()

    def rebuilt(part: Column, place: Column) -> Column:
        plain = ~part.rlike("[\ue000\ue002]")
        bare = plain & ((part.startswith("[") & part.endswith("]")) | is_number(part))
        return F.when((place % 2 == 0) | F.coalesce(bare, F.lit(False)), part).otherwise(
            F.concat(F.lit('"'), part, F.lit('"'))
        )

    joined = F.array_join(F.transform(parts, rebuilt), "")
    back = F.regexp_replace(F.replace(joined, F.lit("\ue002"), F.lit('\ue000"\ue001')), "\ue000(.)\ue001", r"\\$1")
    return F.when(F.size(parts) % 2 == 0, col).otherwise(back)
