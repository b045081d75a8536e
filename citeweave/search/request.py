"""A search request, its JSON form, and its compilation to hits and facets."""

from __future__ import annotations

import dataclasses
import json
import re
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.operators.stats import term_facet


@dataclass
class Clause:
    """One condition. kind: match_all, term, range, query_string, prefix, any_of, nested."""

    kind: str
    field: str = ""
    value: object = None
    lo: object = None
    hi: object = None
    clauses: list[Clause] = dataclasses.field(default_factory=list)


@dataclass
class Facet:
    """kind: terms or date_histogram."""

    name: str
    field: str
    kind: str = "terms"
    size: int = 10
    order: str = "count"
    interval: str = "month"
    clauses: list[Clause] = dataclasses.field(default_factory=list)


@dataclass
class SearchRequest:
    must: list[Clause] = dataclasses.field(default_factory=list)
    must_not: list[Clause] = dataclasses.field(default_factory=list)
    should: list[Clause] = dataclasses.field(default_factory=list)
    always: list[Clause] = dataclasses.field(default_factory=list)
    facets: list[Facet] = dataclasses.field(default_factory=list)
    offset: int = 0
    size: int = 10
    sort: list[tuple[str, str]] = dataclasses.field(default_factory=list)
    fields: list[str] = dataclasses.field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> SearchRequest:
        raw = json.loads(text)

        def clause(c: dict) -> Clause:
            return Clause(**{**c, "clauses": [clause(x) for x in c.get("clauses", [])]})

        for k in ("must", "must_not", "should", "always"):
            raw[k] = [clause(c) for c in raw.get(k, [])]
        raw["facets"] = [Facet(**{**f, "clauses": [clause(c) for c in f.get("clauses", [])]}) for f in raw.get("facets", [])]
        raw["sort"] = [tuple(s) for s in raw.get("sort", [])]
        return cls(**raw)


@dataclass
class SearchResult:
    total: DataFrame
    hits: DataFrame
    facets: dict[str, DataFrame]


def _is_array(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes).get(name, "").startswith("array")


def _test(df: DataFrame, name: str, test) -> Column:
    """The test of a column, or of any element of an array."""
    return F.exists(name, test) if _is_array(df, name) else test(F.col(name))


def term_predicate(text: Column, word: str) -> Column:
    """One word of a query text: ``*`` and ``?`` stand for characters, ``word~2`` allows edits, quotes for a phrase."""
    text = F.lower(text)
    if word.startswith('"'):
        return F.contains(text, F.lit(word.strip('"').lower()))
    if m := re.fullmatch(r"(\w+)~(\d?)", word):
        near = F.lit(m[1].lower())
        return F.exists(F.split(text, r"\W+"), lambda w: F.levenshtein(w, near) <= int(m[2] or 2))
    if "*" in word or "?" in word:
        pattern = "".join(r"\w*" if c == "*" else r"\w" if c == "?" else re.escape(c) for c in word.lower())
        return text.rlike(rf"(^|\W){pattern}($|\W)")
    return F.array_contains(F.split(text, r"\W+"), word.lower())


def query_string(df: DataFrame, query: str, default: str) -> Column:
    """Words joined by AND (understood) and OR, with ``field:word``; AND binds more closely."""
    words = re.findall(r'(?:\w+:)?"[^"]*"|\S+', query)
    groups: list[list[Column]] = [[]]
    for w in words:
        if w == "OR":
            groups.append([])
        elif w != "AND":
            name, _, rest = w.partition(":") if re.match(r"\w+:\S", w) else (default, "", w)
            groups[-1].append(_test(df, name, lambda x, r=rest: term_predicate(x, r)))
    return reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, g) for g in groups if g], F.lit(not any(groups)))


def condition(df: DataFrame, c: Clause) -> Column:
    if c.kind == "match_all":
        return F.lit(True)
    if c.kind == "term":
        return _test(df, c.field, lambda x: x == c.value)
    if c.kind == "any_of":  # values of one facet: a lone value is a term
        return _test(df, c.field, lambda x: x.isin(list(c.value)))
    if c.kind == "range":
        lo, hi = F.lit(True) if c.lo is None else None, F.lit(True) if c.hi is None else None
        return _test(df, c.field, lambda x: (x >= F.lit(c.lo) if lo is None else lo) & (x <= F.lit(c.hi) if hi is None else hi))
    if c.kind == "prefix":  # a single letter in either case
        return _test(df, c.field, lambda x: x.startswith(str(c.value).upper()) | x.startswith(str(c.value).lower()) | x.startswith(str(c.value)))
    if c.kind == "query_string":
        return query_string(df, str(c.value), c.field)
    if c.kind == "nested":  # all conditions hold of one element
        return F.exists(c.field, lambda e: reduce(lambda a, b: a & b, [_inner(e, x) for x in c.clauses], F.lit(True)))
    raise ValueError(f"unknown clause {c.kind}")


def _inner(element: Column, c: Clause) -> Column:
    x = element[c.field]
    if c.kind == "term":
        return x == c.value
    if c.kind == "any_of":
        return x.isin(list(c.value))
    if c.kind == "range":
        return (x >= F.lit(c.lo) if c.lo is not None else F.lit(True)) & (x <= F.lit(c.hi) if c.hi is not None else F.lit(True))
    raise ValueError(f"unknown nested clause {c.kind}")


def predicate(df: DataFrame, r: SearchRequest) -> Column:
    out = reduce(lambda a, b: a & b, [condition(df, c) for c in r.must + r.always], F.lit(True))
    out = reduce(lambda a, b: a & b, [~F.coalesce(condition(df, c), F.lit(False)) for c in r.must_not], out)
    return out & reduce(lambda a, b: a | b, [condition(df, c) for c in r.should]) if r.should else out


def search(df: DataFrame, r: SearchRequest) -> SearchResult:
    """Filters once; a page of ordered hits with the fields asked for, and each facet over all that match."""
    found = df.where(predicate(df, r))
    order = [F.desc(f) if way == "desc" else F.asc(f) for f, way in r.sort]
    hits = (found.orderBy(*order) if order else found).offset(r.offset).limit(r.size)
    facets = {}
    for f in r.facets:
        rows = found.where(reduce(lambda a, b: a & b, [condition(found, c) for c in f.clauses], F.lit(True)))
        value = F.explode(f.field) if _is_array(df, f.field) else F.col(f.field)
        if f.kind == "terms":
            facets[f.name] = term_facet(rows, value, f.size, f.order)
        else:
            facets[f.name] = rows.groupBy(F.date_trunc(f.interval, f.field).alias("time")).agg(F.count("*").alias("count"))
    return SearchResult(found.agg(F.count("*").alias("total")), hits.select(*r.fields) if r.fields else hits, facets)


def suggest(df: DataFrame, column: str, term: str, size: int = 100) -> DataFrame:
    """Completions of what was typed: a letter is a prefix in either case, a word may stand anywhere, of several the last is open."""
    words = term.lower().split()
    text = F.lower(F.col(column))
    if len(term) == 1:
        keep = F.col(column).startswith(term.upper()) | F.col(column).startswith(term.lower())
    elif len(words) == 1:
        keep = F.contains(text, F.lit(words[0]))
    else:
        parts = F.split(text, r"\W+")
        keep = reduce(lambda a, b: a & b, [F.array_contains(parts, w) for w in words[:-1]] + [F.exists(parts, lambda p: p.startswith(words[-1]))])
    return term_facet(df.where(keep), F.col(column), size)


def token_index(df: DataFrame, key: str, column: str) -> DataFrame:
    """(token, key): the full-text index as a table; commas are blanks."""
    tokens = F.explode(F.array_distinct(F.split(F.lower(F.translate(column, ",", " ")), r"\s+")))
    return df.select(tokens.alias("token"), key).where("token <> ''")


def _ranked(papers: DataFrame, ids: DataFrame, cites: DataFrame) -> DataFrame:
    """The papers of ``ids`` with how often they are cited; of all citations only theirs are counted."""
    own = cites.join(ids.select(F.col("id").alias("dst")), "dst", "left_semi").groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("citations"))
    return papers.join(ids, "id", "left_semi").join(own, "id", "left").withColumn("citations", F.coalesce("citations", F.lit(0)))


def paper_view(paper, papers: DataFrame, cites: DataFrame, unknown: DataFrame) -> dict[str, DataFrame]:
    """A paper's page: itself, what it cites and what cites it by citations, and references that are nowhere."""
    out = cites.where(F.col("src") == paper).select(F.col("dst").alias("id")).distinct()
    into = cites.where(F.col("dst") == paper).select(F.col("src").alias("id")).distinct()
    own = papers.where(F.col("id") == paper).select("id")
    return {
        "paper": _ranked(papers, own, cites), "references": _ranked(papers, out, cites).orderBy(F.desc("citations"), "id"),
        "cited_by": _ranked(papers, into, cites).orderBy(F.desc("citations"), "id"), "unknown": unknown.where(F.col("src") == paper),
    }


def author_view(name: str, authorship: DataFrame, papers: DataFrame, cites: DataFrame) -> DataFrame:
    """An author's papers, most cited first."""
    mine = authorship.where(F.col("name") == name).select(F.col("paper").alias("id")).distinct()
    return _ranked(papers, mine, cites).orderBy(F.desc("citations"), "id")


def search_view(query: str, index: DataFrame, papers: DataFrame, cites: DataFrame, limit: int = 100) -> DataFrame:
    """Papers that have all of the query's words, most cited first."""
    wanted = sorted({w for w in re.split(r"\W+", query.lower()) if w})
    hits = index.where(F.col("token").isin(wanted)).groupBy("id").agg(F.count_distinct("token").alias("k")).where(F.col("k") == len(wanted))
    return _ranked(papers, hits.select("id"), cites).orderBy(F.desc("citations"), "id").limit(limit)
