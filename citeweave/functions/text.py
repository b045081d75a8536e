"""String, token and name functions as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def to_ascii(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without what isn't ASCII. Spark has no such built-in."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())


@F.pandas_udf(T.StringType())
def to_char_refs(s: pd.Series) -> pd.Series:
    """ASCII with XML character references for all else."""
    return s.map(lambda x: None if x is None else x.encode("ascii", "xmlcharrefreplace").decode())


def clean_field(s: Column) -> Column:
    """ASCII text that can stand between pipes on one line."""
    return F.translate(to_ascii(s), "\n|", "")


def strip_end_punctuation(s: Column) -> Column:
    return F.regexp_replace(s, r"[.,\s]+$", "")


def unwrap_braces(s: Column) -> Column:
    """The inside of a text that is one braced group, with or without a dot after it."""
    inner = F.trim(F.regexp_extract(s, r"(?s)^\s*\{(.*)\}\.?\s*$", 1))
    return F.when(s.rlike(r"(?s)^\s*\{.*\}\.?\s*$"), inner).otherwise(s)


def words(s: Column) -> Column:
    """Lower-case runs of ASCII letters."""
    return F.regexp_extract_all(F.lower(s), F.lit("([a-z]+)"), 1)


def token_coverage(title: Column, text: Column) -> Column:
    """Different title words that the text holds, by the title's words with repeats; 0 for a title without words."""
    t = words(title)
    found = F.size(F.array_intersect(t, words(text))) / F.size(t)
    return F.when(F.coalesce(F.size(t), F.lit(0)) > 0, F.coalesce(found, F.lit(0.0))).otherwise(F.lit(0.0))


def guess_year(s: Column) -> Column:
    """The last year in parentheses of 1800 to 2050, else the last bare one of 1800 to 2020, else null."""

    def last(pattern: str, most: int) -> Column:
        years = F.transform(F.regexp_extract_all(s, F.lit(pattern), 1), lambda y: y.cast("int"))
        return F.try_element_at(F.filter(years, lambda y: (y >= 1800) & (y <= most)), F.lit(-1))

    return F.coalesce(last(r"\((\d{4})\)", 2050), last(r"\b(\d{4})\b", 2020))


def surname(s: Column) -> Column:
    return F.substring_index(s, ",", 1)


def abbreviated(s: Column) -> Column:
    """``Last, First Middle`` as ``Last F. M.``"""
    first = F.substring_index(s, ",", -1)
    initials = F.transform(F.regexp_extract_all(first, F.lit(r"(\S)\S*"), 1), lambda c: F.concat(c, F.lit(".")))
    return F.when(F.instr(s, ",") > 0, F.concat_ws(" ", surname(s), F.array_join(initials, " "))).otherwise(s)


def display_names(names: Column, shown: int = 3) -> Column:
    """Sorted names, the first ones followed by ``et.al.`` where there are more."""
    ordered = F.array_sort(names)
    some = F.array_join(F.slice(ordered, 1, shown), ", ")
    return F.when(F.size(names) > shown, F.concat(some, F.lit(" et.al."))).otherwise(some)


def display_name(given: Column, family: Column, style: Column) -> tuple[Column, Column]:
    """(name, sort name) in ``western``, ``eastern`` or ``islensk`` order."""
    given_first, family_first = F.concat_ws(" ", given, family), F.concat_ws(" ", family, given)
    name = F.when(style == "eastern", family_first).otherwise(given_first)
    sort = F.when(style == "islensk", F.concat_ws(", ", given, family)).otherwise(F.concat_ws(", ", family, given))
    return name, sort


def slug(s: Column) -> Column:
    """Lower case with one hyphen for each run of marks and blanks; curly quotes go."""
    plain = F.translate(s, "\u2018\u2019\u201c\u201d", "")
    return F.regexp_replace(F.lower(F.regexp_replace(plain, r"[!-/:-@\[-`{-~\s]+", "-")), "-+$", "")


def tidy_journal(s: Column) -> Column:
    """A journal's abbreviation in lower case without dots, with single blanks."""
    return F.trim(F.regexp_replace(F.replace(F.lower(s), F.lit("."), F.lit("")), r"\s+", " "))


def emails(s: Column) -> Column:
    """Different mail addresses in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(s, F.lit(r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4})"), 1))


def file_slug(s: Column) -> Column:
    return F.regexp_replace(s, r"[^A-Za-z0-9]+", "_")


def search_terms(s: Column) -> Column:
    """The lower-cased words of a search text; all have to match."""
    return F.filter(F.split(F.lower(s), r"\W+"), lambda w: w != "")


def spread_initials(s: Column) -> Column:
    """Tokens in capitals as single letters: ``RJ Smith`` -> ``R J Smith``."""
    parts = F.transform(F.split(s, " "), lambda w: F.when(w.rlike("^[A-Z]{2,}$"), F.array_join(F.split(w, ""), " ")).otherwise(w))
    return F.trim(F.array_join(parts, " "))


def first_image_url(record: Column) -> Column:
    """The first image address in a record, wherever it stands."""
    return F.nullif(F.regexp_extract(F.to_json(record), r'(?i)(https?://[^\s"]+?\.(?:jpg|jpeg|gif|png|bmp))', 1), F.lit(""))


def squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def padded(s: Column, width: int) -> Column:
    return F.rpad(F.coalesce(s, F.lit("")), width, " ")


def author_guesses(s: Column) -> Column:
    """Of the first five words of two letters or more: capitalised, and not ``The``; which of them are authors a join tells."""
    first = F.slice(F.regexp_extract_all(s, F.lit(r"([A-Za-z]{2,})"), 1), 1, 5)
    return F.filter(first, lambda w: w.rlike("^[A-Z]") & (w != "The"))
