"""TeX bibliographies: environments, items and their fields."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What is taken out of a TeX reference.
TEX_CODES = ("\\it", "\\bf", "\\sc", "\\em", "\\emph", "\\textbf", "\\textit", "\\textsc", "\\newblock")
TEX_WORDS = (
    "endcsname", "providecommand", "newblock", "samestyle", "csname", "href", "author", "pages",
    "title", "citenamefont", "bibnamefont", "BibitemOpen", "penalty0", "bibfield",
)


def without_comments(s: Column) -> Column:
    """Every line up to its first percent sign."""
    return F.regexp_replace(s, r"%[^\n]*", "")


def without_comment_lines(s: Column) -> Column:
    """Without lines that are comments only, white space squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"(?m)^\s*%.*$", ""), r"\s+", " "))


def environment(s: Column, name: str) -> Column:
    """All bodies of an environment, one after another."""
    return F.array_join(F.regexp_extract_all(s, F.lit(rf"(?s)\\begin\{{{name}\}}(.*?)\\end\{{{name}\}}"), 1), "")


def bibitems(s: Column, skip: int = 1) -> Column:
    """The bibliography's items; what stands before the first, and each item's key, is dropped."""
    parts = F.split(environment(without_comments(s), "thebibliography"), r"\\bibitem")
    return F.transform(F.slice(parts, skip + 1, 1 << 30), lambda x: F.regexp_replace(F.regexp_replace(x, r"(?s)^.*?\}", ""), r"^\s+|\s+$", ""))


def _either(names) -> str:
    """One pattern for all names, longest first, so that none hides a longer one."""
    return "|".join(sorted((n.removeprefix("\\") for n in names), key=lambda n: (-len(n), n)))


#: A label or a database field with its braced content; a font or block command as a whole word.
_TEX_MARKUP = rf"\\(?:(?:label|bibinfo)\s*\{{[^{{}}]*\}}|(?:{_either(TEX_CODES)})(?![A-Za-z]))"
_MACRO_REST = rf"(?<![A-Za-z0-9])(?:{_either(TEX_WORDS)})(?![A-Za-z0-9])"


def plain(s: Column) -> Column:
    """A TeX reference as plain text: no commands, no braces or other marks, no leftovers of macros; letters of all scripts stay."""
    bare = F.regexp_replace(s, r'\\"', "")
    bare = F.regexp_replace(F.regexp_replace(bare, _TEX_MARKUP, " "), r"[^\p{L}\p{N}_.,:()/-]+", " ")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, _MACRO_REST, ""), r"\s+", " "), r"^[\s,]+|\s+$", "")


def label_and_key(s: Column) -> tuple[Column, Column]:
    """``[label]{key}`` at the beginning."""
    pattern = r"^\s*(?:\[([^\]]*)\])?\s*\{([^}]*)\}"
    return tuple(F.nullif(F.regexp_extract(s, pattern, i), F.lit("")) for i in (1, 2))


def url(s: Column) -> Column:
    r"""The address in ``\url{...}``, else the first bare one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(s, p, 1), F.lit("")) for p in (r"\\url\{(https?://[^}]+)\}", r"(https?://[^\s{}]+)")])


_YEAR = r"\(((?:18|19|20)\d{2})\)"


def year(s: Column) -> Column:
    return F.nullif(F.regexp_extract(s, _YEAR, 1), F.lit(""))


def year_and_rest(s: Column) -> tuple[Column, Column]:
    """The first year in parentheses, and the text without it."""
    return year(s), F.regexp_replace(s, rf"^((?s:.*?)){_YEAR}", "$1")


def _nested(levels: int = 4) -> str:
    """The inside of a brace group that has groups inside, so many levels deep."""
    inside = r"[^{}]*+"
    for _ in range(levels):
        inside = rf"(?:[^{{}}]++|\{{{inside}\}})*+"
    return inside


def _before(s: Column, pattern: str) -> Column:
    return F.when(s.rlike(pattern), F.element_at(F.split(s, pattern, 2), 1))


def authors(s: Column) -> Column:
    r"""What stands before ``\newblock``, else before emphasis, else before a control space, else all."""
    return F.trim(F.coalesce(_before(s, r"\\newblock"), _before(s, r"\{?\\(?:emph|em|textit)\b"), _before(s, r"\\ "), s))


def title(s: Column) -> Column:
    """The title's place: a new block, emphasis, a sentence, a comma, or all there is."""

    def group(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))

    found = F.coalesce(
        group(r"(?s)\\newblock\s+(.*?)(?:\\newblock|$)"),
        group(rf"\\(?:emph|textit)\{{({_nested()})\}}"),
        group(rf"\{{\\(?:em|it)\s+({_nested()})\}}"),
        group(r"(?s)\. (.+?)(?:\. |$)"),
        group(r"(?s)\.(.+?)(?:\.|$)"),
        group(r"(?s), (.+?)(?:, |$)"),
        s,
    )
    return F.trim(F.regexp_replace(F.regexp_replace(found, r"[{}]", ""), r"[.,\s]+$", ""))


def publisher(s: Column) -> Column:
    r"""What follows the last ``\newblock``."""
    rest = F.when(s.rlike(r"\\newblock.*\\newblock"), F.substring_index(s, "\\newblock", -1))
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(rest, r"[{}]", ""), r"[.,\s]+$", "")), F.lit(""))


def braced(text: str, level: int = 1, number: int = 1) -> tuple[str, str]:
    r"""(inside of the number-th brace group of a level, what follows it); a leading ``\em`` goes.

    Inside, the text at that depth or deeper is kept, without the braces themselves.
    """
    depth = found = 0
    out: list[str] = []
    for i, c in enumerate(text):
        if c == "{":
            depth += 1
            if depth == level:
                found += 1
        elif c == "}":
            if depth == level and found == number:
                inner = "".join(out)
                return (inner[4:] if inner.startswith("\\em ") else inner), text[i + 1 :]
            depth -= 1
        elif depth >= level and found == number:
            out.append(c)
    return "".join(out), ""


@F.pandas_udf(T.StructType([T.StructField("parsed", T.StringType()), T.StructField("rest", T.StringType())]))
def parse_braces(s: pd.Series, level: pd.Series, number: pd.Series) -> pd.DataFrame:
    """:func:`braced` as a column function; nested counts have no built-in."""
    rows = [(None, None) if t is None else braced(t, int(n), int(k)) for t, n, k in zip(s, level, number, strict=True)]
    return pd.DataFrame(rows, columns=["parsed", "rest"])


def citations(source: Column) -> Column:
    """Items as structs in order: position, key, label, year, url, authors, title, publisher and text."""
    env = F.split(environment(without_comments(source), "thebibliography"), r"\\bibitem")

    def one(x: Column, i: Column) -> Column:
        label, key = label_and_key(x)
        body = F.trim(F.regexp_replace(x, r"^\s*(?:\[[^\]]*\])?\s*\{[^}]*\}", ""))
        return F.struct(
            (i + 1).alias("cite_order"), label.alias("label"), key.alias("key"), year(body).alias("year"), url(body).alias("url"),
            authors(body).alias("authors"), title(body).alias("title"), publisher(body).alias("publisher"), body.alias("latex"),
        )

    return F.transform(F.slice(env, 2, 1 << 30), one)
