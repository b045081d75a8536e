"""Records from nodes and edges, and what refers to what in them.

nodes(doc, id, type, data: map), edges(doc, type, source, target, data: map), as
:mod:`citeweave.sources.projection` makes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An article's fields with the node's keys that they come from, and roles.
ARTICLE = {k: k for k in "title year month day volume issue doi pmid pmc abstract".split()} | {
    "page_start": "fpage", "page_end": "lpage", "citation": "full_citation", "pointers": "in_text_reference_pointer_count", "references": "reference_count",
    "work_type": "fabio_type", "source_type": "provenance", "url": "uri",
}
ROLES = {"author": ("author", "allauthors"), "editor": ("editor",), "translator": ("translator",)}


def _value(key: str) -> Column:
    return F.nullif(F.trim(F.try_element_at("data", F.lit(key))), F.lit(""))


def outgoing(nodes: DataFrame, edges: DataFrame | None, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Every node with its edges, an empty list where it has none: (..., out: array of (position, type, role, target)).

    ``kinds``: only edges of these types, so that others, which may be most, are neither made nor shuffled. Without a table of
    edges nodes have ``out`` already, as :func:`citeweave.sources.projection.linked` makes them.
    """
    if edges is None:
        return nodes
    edges = edges.where(F.col("type").isin(*kinds)) if kinds else edges
    position = F.try_element_at("data", F.lit("position")).cast("int")
    edge = F.struct(F.coalesce(position, F.lit(0)).alias("position"), "type", F.try_element_at("data", F.lit("contrib-type")).alias("role"), "target")
    out = edges.groupBy("doc", F.col("source").alias("id")).agg(F.sort_array(F.collect_list(edge)).alias("out"))
    return nodes.join(out, ["doc", "id"], "left").withColumn("out", F.coalesce("out", F.array().cast(out.schema["out"].dataType)))


def _targets(keep) -> Column:
    return F.transform(F.filter("out", keep), lambda e: e["target"])


def articles(nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Articles with their fields, people by role, journal, citations and retractions, each in order; and the works that these name, where nodes have them."""
    rows = outgoing(nodes.where("type = 'article'"), edges, ("contributor", "journal", "cites", "retracts"))
    first, last = _value("fpage"), _value("lpage")

    def people_of(role: str) -> Column:
        return _targets(lambda e: (e["type"] == "contributor") & e["role"].isin(*ROLES[role]))

    return rows.select(
        "doc", "id", F.lit("Article").alias("type"), *[_value(v).alias(k) for k, v in ARTICLE.items()], F.concat(first, F.lit("--"), last).alias("pages"), *[people_of(r).alias(r) for r in ROLES],
        F.try_element_at(_targets(lambda e: e["type"] == "journal"), F.lit(1)).alias("journal"), _targets(lambda e: e["type"] == "cites").alias("cites"), _targets(lambda e: e["type"] == "retracts").alias("retracts"),
        *[c for c in ("cited", "retracted") if c in rows.columns],
    )


def journals(nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    rows = outgoing(nodes.where("type = 'journal'"), edges, ("publisher",))
    names = {"name": "title", "abbreviation": "nlm_ta", "issn": "issn", "eissn": "eissn"}
    return rows.select("doc", "id", F.lit("Journal").alias("type"), *[_value(v).alias(k) for k, v in names.items()], F.try_element_at(_targets(lambda e: e["type"] == "publisher"), F.lit(1)).alias("publisher"))


def people(nodes: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """People as ``Surname, Given``; a name given whole stands where the parts are missing. Affiliated with the last of their places."""
    rows = outgoing(nodes.where("type = 'person'"), edges, ("affiliation",))
    parts = F.nullif(F.concat_ws(", ", _value("surname"), _value("given-names")), F.lit(""))
    return rows.select(
        "doc", "id", F.lit("Person").alias("type"), F.coalesce(parts, _value("name")).alias("name"), _value("surname").alias("surname"), _value("given-names").alias("given"),
        F.coalesce(_value("name-style"), F.lit("western")).alias("style"), F.try_element_at(_targets(lambda e: e["type"] == "affiliation"), F.lit(-1)).alias("affiliated"),
    )


def organisations(nodes: DataFrame) -> DataFrame:
    rows = nodes.where(F.col("type").isin("organisation", "organization"))
    return rows.select("doc", "id", F.lit("Organization").alias("type"), _value("name").alias("name"), _value("address").alias("address"), organisation_key(_value("name"), _value("address")).alias("key"))


def organisation_key(name: Column, address: Column) -> Column:
    """One number for organisations of the same name and address; a missing part is unlike any other."""
    return F.xxhash64(F.to_json(F.struct(name.alias("n"), address.alias("a"))))


def dereferenced(rows: DataFrame, key: str, refs: str, uris: DataFrame) -> DataFrame:
    """``rows`` with each id of the list ``refs`` replaced by its URI, where it has one, in order. uris(id, uri).

    An id without a URI stays: it names a record of the data set. A list inside a record is a
    table of its own, dereferenced in the same way.
    """
    each = rows.select(key, F.posexplode(refs).alias("_pos", "_ref")).join(uris.select(F.col("id").alias("_ref"), F.col("uri").alias("_uri")), "_ref", "left")
    named = F.struct("_pos", F.coalesce("_uri", "_ref").alias("to"))
    lists = each.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(named)), lambda x: x["to"]).alias("_refs"))
    out = rows.join(lists, key, "left").withColumn(refs, F.coalesce("_refs", F.array().cast("array<string>")))
    return out.drop("_refs")


def distinct_names(rows: DataFrame, name: str) -> DataFrame:
    """One node for each name as it is written: (id, name)."""
    return rows.where(F.col(name).isNotNull()).select(F.xxhash64(name).alias("id"), F.col(name).alias("name")).distinct()


def journal_identifier(issn: Column, kind: Column) -> Column:
    """A journal's identifier by the kind of its ISSN; without a kind it is the printed one's."""
    scheme = F.when(kind == "epub", "eissn").otherwise("issn")
    return F.when(F.coalesce(F.trim(issn), F.lit("")) != "", F.concat_ws(":", scheme, F.trim(issn)))


def article_rows(records: DataFrame) -> DataFrame:
    """Articles as flat rows for a CSV file: texts only, on one line each."""
    flat = [F.regexp_replace(F.coalesce(F.col(c).cast("string") if t == "string" else F.array_join(c, " "), F.lit("")), r"\s+", " ").alias(c) for c, t in records.dtypes if t in ("string", "array<string>")]
    return records.select(*flat)


def citation_rows(records: DataFrame) -> DataFrame:
    """(source, target, count) of what articles cite, one row a pair."""
    return records.select(F.col("id").alias("source"), F.explode("cites").alias("target")).groupBy("source", "target").agg(F.count("*").alias("count"))


def citing_contexts(docs: DataFrame, wanted: list[str], key: str = "path") -> DataFrame:
    """(doc, paragraph, ref, title) of the in-text pointers of some articles, with what they point to."""
    rows = docs.where(F.col(key).isin(*wanted)).select(F.col(key).alias("doc"), "citation", F.explode("pointer").alias("p"))
    each = rows.select("doc", "citation", F.col("p.paragraph").alias("paragraph"), F.explode("p.rids").alias("ref"))
    title = F.try_element_at(F.filter("citation", lambda c: c["id"] == F.col("ref")), F.lit(1))["title"]
    return each.select("doc", "paragraph", "ref", title.alias("title"))
