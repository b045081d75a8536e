"""Records as quads (subject, predicate, object, graph)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = "http://example.org/"


def iri(c: Column, base: str = BASE) -> Column:
    """An IRI in angle brackets, relative ones under the base; null if a character is not allowed in one."""
    return _apart(c, lambda x: _iri(x, base))


def _iri(c: Column, base: str) -> Column:
    full = F.when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), c).otherwise(F.concat(F.lit(base), c))
    return F.when(full.rlike(r"\A[^\x00-\x20<>\"{}|^`\\]*+\z"), F.concat(F.lit("<"), full, F.lit(">")))


def _apart(c: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of a value that is taken once. A row has dozens of them: written out in one generated method they make it too long to be compiled, and it is interpreted instead."""
    return F.get(F.transform(F.array(c), made), 0)


def literal(c: Column, datatype: str | None = None) -> Column:
    def whole(c: Column) -> Column:
        out = F.replace(c, F.lit("\\"), F.lit("\\\\"))
        for char, code in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            out = F.replace(out, F.lit(char), F.lit(code))
        return F.concat(F.lit('"'), out, F.lit(f'"^^<{datatype}>' if datatype else '"'))

    return _apart(c.cast("string"), whole)


def quads(df: DataFrame, subject: Column, properties: dict[str, Column], graph: Column, base: str = BASE) -> DataFrame:
    """One quad for each property of each row that isn't null; a quad with an illegal IRI is left out.

    Values come from :func:`iri` or :func:`literal`.
    """
    return quads_about(df, [(subject, properties)], graph, base)


def quads_about(df: DataFrame, said: list[tuple[Column, dict[str, Column]]], graph: Column, base: str = BASE) -> DataFrame:
    """As :func:`quads`, of several subjects of each row in one pass; a subject that is null has no quads.

    Subjects and values are made once a row, before the rows become quads.
    """
    subjects = [iri(s, base).alias(f"_s{i}") for i, (s, _) in enumerate(said)]
    values = [v.alias(f"_o{i}_{j}") for i, (_, properties) in enumerate(said) for j, v in enumerate(properties.values())]
    made = df.select(iri(graph, base).alias("g"), *subjects, *values)
    each = [F.struct(F.col(f"_s{i}").alias("s"), _iri(F.lit(p), base).alias("p"), F.col(f"_o{i}_{j}").alias("o")) for i, (_, properties) in enumerate(said) for j, p in enumerate(properties)]
    rows = made.select(F.explode(F.array(*each)).alias("x"), "g").select("x.s", "x.p", "x.o", "g")
    return rows.where("s IS NOT NULL AND p IS NOT NULL AND o IS NOT NULL AND g IS NOT NULL")


def ordered_list(df: DataFrame, list_id: Column, key: str, pos: str, item: Column, graph: Column, base: str = BASE) -> DataFrame:
    """A citation list as linked items: first, next, last and what each holds."""
    from citeweave.operators.windows import link_next

    linked = link_next(df, key, pos)

    def node(p: Column) -> Column:
        return F.concat(list_id, F.lit("/item/"), p.cast("string"))

    own = quads(linked, node(F.col(pos)), {"list#itemContent": iri(item, base), "list#nextItem": iri(node(F.col("next")), base)}, graph, base)
    ends = quads(linked, list_id, {"list#firstItem": iri(F.when(F.col("is_first"), node(F.col(pos))), base), "list#lastItem": iri(F.when(F.col("is_last"), node(F.col(pos))), base)}, graph, base)
    return own.unionByName(ends)


def lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.concat_ws(" ", "s", "p", "o", "g"), F.lit(" .")).alias("value"))
