"""Parsed articles as nodes and edges: one projection for each kind, all of one table of records.

``docs`` is :func:`citeweave.sources.xml.articles`' result. An article's node has the best of
its identifiers as id; what belongs to it is named below that id.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeweave.functions import ids
from citeweave.sources import xml

#: The edges that leave a node, in order.
OUT = "array<struct<position:int,type:string,role:string,target:string>>"
NODE, EDGE = ["doc", "id", "type", "data"], ["doc", "type", "source", "target", "data"]


def _data(**values: Column) -> Column:
    """A map of what there is: no nulls, no empty texts."""
    pairs = [x for k, c in values.items() for x in (F.lit(k.replace("__", "-")), c.cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull() & (v != ""))


def id_of(identifiers: Column, scheme: str) -> Column:
    return F.try_element_at(F.filter(identifiers, lambda x: x["type"] == scheme), F.lit(1))["id"]


def id_map(identifiers: Column) -> Column:
    """An identifier list as a map; of one scheme the last counts."""
    return F.map_from_entries(F.transform(F.array_distinct(F.transform(identifiers, lambda x: x["type"])), lambda t: F.struct(t, F.element_at(F.filter(identifiers, lambda x: x["type"] == t), -1)["id"])))


def article_id(identifiers: Column, key: Column) -> Column:
    """pmid, pmc, doi, whichever comes first; else the file's own key."""
    return ids.preferred_id(id_of(identifiers, "pmid"), id_of(identifiers, "pmc"), id_of(identifiers, "doi"), F.concat(F.lit("file:"), key))


def _each(docs: DataFrame, column: str, keep: str = "path") -> DataFrame:
    """One row for each item of an article's list, numbered from 1."""
    return docs.select("doc", "root", F.posexplode(column).alias("pos", "x")).withColumn("pos", F.col("pos") + 1)


def _rooted(docs: DataFrame, key: str) -> DataFrame:
    return docs.where("error IS NULL").withColumn("doc", F.col(key)).withColumn("root", article_id(F.col("identifier"), F.col(key)))


def _below(*names: str | Column) -> Column:
    return F.concat_ws(":", "root", *[n if isinstance(n, Column) else F.lit(n) for n in names])


def _retracted(docs: DataFrame) -> DataFrame:
    """Articles that an article takes back, by number, DOI or address; what names none is no node."""
    rows = _each(docs, "related").where(F.col("x.href").isNotNull())
    return rows.select("doc", "root", "pos", *[c.alias(k) for k, c in _gone_ids(F.col("x")).items()])


def _gone_ids(x: Column) -> dict[str, Column]:
    """How an article that is taken back is named."""
    pmid, doi = F.when(x["link"] == "pubmed", x["href"]), F.nullif(F.regexp_extract(x["href"], "^info:doi/(.+)$", 1), F.lit(""))
    return {"pmid": pmid, "doi": F.when(pmid.isNull(), doi), "uri": F.when(pmid.isNull() & doi.isNull(), x["href"])}


def _cited_ids(x: Column) -> dict[str, Column]:
    """How a cited work is named; by its text where it has no kind."""
    untyped, found = F.coalesce(x["kind"], F.lit("other")) == "other", ids.salvage(x["text"])
    return {"doi": F.coalesce(id_of(x["identifier"], "doi"), F.when(untyped, found["doi"])), "pmid": id_of(x["identifier"], "pmid"), "uri": F.when(untyped, found["uri"])}


def marks(docs: DataFrame, key: str = "path") -> DataFrame:
    """(doc, root, id, section, paragraph, place, text, first, last, rids, refs) of in-text pointers.

    ``refs`` is the article's reference list, (id, list) in order. A range has ``first`` and ``last``, any other pointer ``rids``.
    """
    docs = docs if "root" in docs.columns else _rooted(docs, key)
    refs = F.transform("citation", lambda c: F.struct(c["id"].alias("id"), c["list"].alias("list")))
    rows = docs.select("doc", "root", refs.alias("refs"), F.posexplode("mark").alias("pos", "x"))
    return rows.select("doc", "root", _below("in-text-reference-pointer", F.col("pos") + 1).alias("id"), "x.*", "refs")


def _ends(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Pointers with the places of a range's ends in the list, 0 where there is none, and whether the range runs forward."""
    names = F.transform("refs", lambda r: r["id"])
    rows = rows.withColumns({"_low": _place(names, F.col("first")), "_high": _place(names, F.col("last"))})
    return rows, (F.col("_low") > 0) & (F.col("_high") > F.col("_low"))


def _place(names: Column, name: Column) -> Column:
    return F.coalesce(F.array_position(names, name), F.lit(0))


def _named(refs: Column, rids: Column, last: Column, low: Column, high: Column) -> Column:
    """The references that a pointer names, or that its range stands for; null for a range that doesn't run forward."""
    of_list = F.get(refs, low.cast("int") - 1)["list"]
    between = F.slice(refs, low.cast("int"), (high - low + 1).cast("int"))
    return F.when(last.isNull(), rids).when((low > 0) & (high > low), F.transform(F.filter(between, lambda r: r["list"] == of_list), lambda r: r["id"]))


def denotes(rows: DataFrame) -> DataFrame:
    """(doc, id, section, paragraph, rank, rid): the references that :func:`marks` point to.

    A range meets the list's order: it stands for all references of the first one's list from there to its last one, or to
    the list's end if that is in a later list. An article's pointers and its list are one row, so nothing is shuffled.
    """
    rows, _ = _ends(rows)
    named = _named(F.col("refs"), F.col("rids"), F.col("last"), F.col("_low"), F.col("_high"))
    return rows.select("doc", "id", "section", "paragraph", F.posexplode(named).alias("rank", "rid"), "root")


def pointer_warnings(rows: DataFrame) -> DataFrame:
    """(doc, id, first, last) of the ranges among :func:`marks` that run backwards or whose ends are no references."""
    rows, forward = _ends(rows)
    return rows.where(F.col("last").isNotNull() & ~forward).select("doc", "id", "first", "last")


#: What :func:`pointed` reads of articles.
POINTED = ("identifier", "citation.id", "citation.list", "mark")


def pointed(docs: DataFrame, key: str = "path") -> DataFrame:
    """(doc, root, id, section, paragraph, odd, rid): :func:`denotes`, and as odd rows without ``rid`` :func:`pointer_warnings`, in one pass over the articles."""
    rows, forward = _ends(marks(docs, key))
    odd = F.col("last").isNotNull() & ~forward
    named = _named(F.col("refs"), F.col("rids"), F.col("last"), F.col("_low"), F.col("_high"))
    each = F.explode(F.when(odd, F.array(F.lit(None).cast("string"))).otherwise(named))
    return rows.select("doc", "root", "id", "section", "paragraph", odd.alias("odd"), each.alias("rid"))


def _article_data(of: Callable[[str], Column]) -> Column:
    """An article's own data; ``of``: its fields by name."""
    names = F.transform(F.filter(of("contributor"), lambda c: c["role"] == "author"), lambda c: F.coalesce(F.nullif(F.concat_ws(" ", c["surname"], c["given"]), F.lit("")), c["collab"]))
    research = F.when(of("heading") == "Research Article", "JournalArticle").otherwise("Expression")
    return _data(
        provenance=F.lit("pmc_oa"), in_oa_subset=F.lit("true"), xml_container=F.lit("article"), ctype=F.coalesce(of("kind"), F.lit("journal-article")), fabio_type=research, title=of("title"),
        year=of("year"), month=of("month"), day=of("day"), volume=of("volume"), issue=of("issue"), fpage=of("firstpage"), lpage=of("lastpage"),
        keywords=F.array_join(of("keyword"), ", "), abstract=of("abstract"), license=of("license"), author=F.array_join(names, ", "), source=F.try_element_at(of("place"), F.lit(1))["address"],
        reference_count=F.size(of("citation")), in_text_reference_pointer_count=F.size(of("mark")),
        **{s: id_of(of("identifier"), s) for s in ("pmc", "pmid", "doi")},)


def _journal_data() -> Column:
    return _data(nlm_ta=F.col("journal_abbr"), issn=F.col("issn"), eissn=F.col("eissn"), title=F.col("journal"))


def _is_group(c: Column) -> Column:
    return c["surname"].isNull() & c["collab"].isNotNull()


def _person_type(c: Column) -> Column:
    return F.when(_is_group(c), "organization").otherwise("person")


def _person_data(c: Column) -> Column:
    return _data(name=F.when(_is_group(c), c["collab"]), surname=c["surname"], given__names=c["given"], name__style=c["style"])


def _cited_person_data(p: Column) -> Column:
    return _data(surname=p["surname"], given__names=p["given"], name__style=p["style"])


def nodes(docs: DataFrame, key: str = "path") -> DataFrame:
    """(doc, id, type, data) of articles, journals, organisations, people, references with their journals and people, retracted articles, sections and in-text pointers."""
    docs = _rooted(docs, key)
    own = docs.select("doc", F.col("root").alias("id"), F.lit("article").alias("type"), _article_data(F.col).alias("data"))
    journal = docs.select("doc", _below("journal").alias("id"), F.lit("journal").alias("type"), _journal_data().alias("data"))
    publisher = docs.where("publisher IS NOT NULL").select("doc", _below("publisher").alias("id"), F.lit("organisation").alias("type"), _data(name=F.col("publisher"), address=F.col("publisher_place")).alias("data"))
    x = F.col("x")
    person = _each(docs, "contributor").select("doc", _below("contributor", F.col("pos")).alias("id"), _person_type(x).alias("type"), _person_data(x).alias("data"))
    place = _each(docs, "place").select("doc", _below("affiliation", F.col("x.id")).alias("id"), F.lit("organisation").alias("type"), _data(address=F.col("x.address"), position=F.col("pos")).alias("data"))
    untyped = F.coalesce("x.kind", F.lit("other")) == "other"
    found = ids.salvage(F.col("x.text"))
    cited = _each(docs, "citation").select("doc", _below("reference", F.col("x.id")).alias("id"), F.lit("article").alias("type"), _data(
        provenance=F.lit("pmc_oa_reference"), ctype=F.coalesce("x.kind", F.lit("none")), fabio_type=ids.work_type(F.col("x.kind")), full_citation=F.col("x.text"), title=F.col("x.title"), source=F.col("x.source"),
        year=F.coalesce("x.year", F.when(untyped, found["year"])), volume=F.col("x.volume"), fpage=F.col("x.firstpage"), lpage=F.col("x.lastpage"), author=F.col("x.authors"),
        **_cited_ids(x), publisher=F.col("x.publisher")).alias("data"))
    gone = _retracted(docs).select("doc", _below("retracted", F.col("pos")).alias("id"), F.lit("article").alias("type"), _data(
        provenance=F.lit("pmc_oa_retraction"), retracted=F.lit("true"), fabio_type=F.lit("Expression"), pmid=F.col("pmid"), doi=F.col("doi"), uri=F.col("uri")).alias("data"))
    of_ref = _below("reference", F.col("x.id"))
    cited_journal = _each(docs, "citation").where("x.source IS NOT NULL").select("doc", F.concat_ws(":", of_ref, F.lit("journal")).alias("id"), F.lit("journal").alias("type"), _data(nlm_ta=F.col("x.source")).alias("data"))
    cited_person = _cited_people(docs).select("doc", "id", F.lit("person").alias("type"), _cited_person_data(F.col("p")).alias("data"))
    section = _each(docs, "section").select("doc", _below("section", F.col("x.path")).alias("id"), F.lit("section").alias("type"), _data(title=F.col("x.title"), sec__type=F.col("x.kind"), place=F.col("x.place")).alias("data"))
    pointer = marks(docs).select("doc", "id", F.lit("in-text-reference-pointer").alias("type"), _data(paragraph=F.col("paragraph"), text=F.col("text"), section=F.col("section"), place=F.col("place")).alias("data"))
    return reduce(DataFrame.unionByName, (own, journal, publisher, person, place, cited, cited_journal, cited_person, gone, section, pointer)).select(*NODE)


def _cited_people(docs: DataFrame) -> DataFrame:
    """The people of cited works' groups, numbered within each work: (doc, ref, id, p)."""
    rows = _each(docs, "citation").select("doc", "root", _below("reference", F.col("x.id")).alias("ref"), F.posexplode("x.people").alias("n", "p"))
    return rows.select("doc", "ref", F.concat_ws(":", "ref", F.lit("contributor"), (F.col("n") + 1).cast("string")).alias("id"), "p")


def edges(docs: DataFrame, key: str = "path") -> DataFrame:
    """(doc, type, source, target, data): journals, publishers, contributors, affiliations, citations, retractions, and what in-text pointers denote.

    A citation's data count the pointers that denote it and list their paragraphs.
    """
    docs = _rooted(docs, key)
    root, none = F.col("root"), F.create_map().cast("map<string,string>")

    def of(rows: DataFrame, kind: str, source: Column, target: Column, data: Column = none) -> DataFrame:
        return rows.select("doc", F.lit(kind).alias("type"), source.alias("source"), target.alias("target"), data.alias("data"))

    people = _each(docs, "contributor")
    person = _below("contributor", F.col("pos"))
    placed = people.select("doc", "root", "pos", F.explode("x.rids").alias("rid"))
    seen = denotes(marks(docs))
    pointed = seen.groupBy("doc", "rid").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list("paragraph")), lambda p: p.cast("string")), " ").alias("paragraphs"))
    # A document without an id of its own for a reference has none to join.
    cited = _each(docs, "citation").withColumn("rid", F.col("x.id")).join(pointed, ["doc", "rid"], "left")
    cited_journal = _each(docs, "citation").where("x.source IS NOT NULL")
    cited_people = _cited_people(docs)
    return reduce(DataFrame.unionByName, (
        of(docs, "journal", root, _below("journal")), of(docs.where("publisher IS NOT NULL"), "publisher", _below("journal"), _below("publisher")),
        of(people, "contributor", root, person, _data(contrib__type=F.col("x.role"), position=F.col("pos"))), of(placed, "affiliation", person, _below("affiliation", F.col("rid"))),
        of(cited, "cites", root, _below("reference", F.col("x.id")), _data(position=F.col("pos"), count=F.coalesce("n", F.lit(0)), paragraphs=F.col("paragraphs"))),
        of(cited_journal, "journal", _below("reference", F.col("x.id")), _below("reference", F.col("x.id"), "journal")),
        of(cited_people, "contributor", F.col("ref"), F.col("id"), _data(contrib__type=F.col("p.role"))),
        of(seen, "denotes", F.col("id"), _below("reference", F.col("rid"))), of(_retracted(docs), "retracts", root, _below("retracted", F.col("pos"))),
    )).select(*EDGE)


#: What :func:`linked` reads of articles, by kind of node.
LINKED = {
    "journal": ("identifier", "journal", "journal_abbr", "issn", "eissn", "publisher", "citation.id", "citation.source"),
    "person": ("identifier", "contributor", "citation.id", "citation.people"),
    "article": ("identifier", "contributor", "citation.id", "related"),
}
#: What :func:`referred` reads of articles.
REFERRED = (*LINKED["article"], "citation.kind", "citation.identifier", "citation.text")


def linked(docs: DataFrame, kind: str, key: str = "path") -> DataFrame:
    """(doc, id, type, data, out) of the nodes of a kind with what leaves them, as :func:`citeweave.operators.records.outgoing` joins
    :func:`nodes` and :func:`edges`; made of each article's row, so that articles are read once and nothing is shuffled.

    ``journal``: articles' journals and cited ones; ``person``: contributors that are no groups, and people of cited works;
    ``article``: the articles themselves, without those that they cite or take back. ``docs`` has the fields of LINKED at
    least; an article's data are those of the fields that it has.
    """
    docs = _rooted(docs, key)
    ref = lambda c: _below("reference", c["id"])
    none = F.array().cast(OUT)

    def edge(type_: str, target: Column, position: Column | None = None, role: Column | None = None) -> Column:
        return F.struct((F.lit(0) if position is None else position).alias("position"), F.lit(type_).alias("type"), (F.lit(None).cast("string") if role is None else F.nullif(role, F.lit(""))).alias("role"), target.alias("target"))

    def node(id_: Column, type_: Column, data: Column, out: Column) -> Column:
        return F.struct(id_.alias("id"), type_.alias("type"), data.alias("data"), out.alias("out"))

    if kind == "journal":
        own = node(_below("journal"), F.lit(kind), _journal_data(), F.when(F.col("publisher").isNotNull(), F.array(edge("publisher", _below("publisher")))).otherwise(none))
        named = F.filter("citation", lambda c: c["source"].isNotNull())
        found = F.concat(F.array(own), F.transform(named, lambda c: node(F.concat_ws(":", ref(c), F.lit("journal")), F.lit(kind), _data(nlm_ta=c["source"]), none)))
    elif kind == "person":
        numbered = F.filter(F.transform("contributor", lambda c, i: F.struct((i + 1).alias("n"), c.alias("c"))), lambda x: _person_type(x["c"]) == "person")
        own = F.transform(numbered, lambda x: node(_below("contributor", x["n"]), F.lit(kind), _person_data(x["c"]), F.sort_array(F.transform(x["c"]["rids"], lambda r: edge("affiliation", _below("affiliation", r))))))
        cited = F.flatten(F.transform("citation", lambda c: F.transform(c["people"], lambda p, i: node(F.concat_ws(":", ref(c), F.lit("contributor"), (i + 1).cast("string")), F.lit(kind), _cited_person_data(p), none))))
        found = F.concat(own, cited)
    elif kind == "article":
        kinds = {f.name: f.dataType for f in StructType.fromDDL(xml.ARTICLE)}
        data = _article_data(lambda f: F.col(f) if f in docs.columns else F.lit(None).cast(kinds[f]))
        gone = F.filter(F.transform("related", lambda x, i: F.struct((i + 1).alias("n"), x["href"].alias("href"))), lambda x: x["href"].isNotNull())
        out = F.sort_array(F.concat(
            F.array(edge("journal", _below("journal"))), F.transform("contributor", lambda c, i: edge("contributor", _below("contributor", i + 1), i + 1, c["role"])),
            F.transform("citation", lambda c, i: edge("cites", ref(c), i + 1)), F.transform(gone, lambda x: edge("retracts", _below("retracted", x["n"]))),
        ))
        return docs.select("doc", F.col("root").alias("id"), F.lit(kind).alias("type"), data.alias("data"), out.alias("out"), *[c for c in ("cited", "retracted") if c in docs.columns])
    else:
        raise ValueError(f"no nodes of kind {kind}")
    return docs.select("doc", F.explode(found).alias("x")).select("doc", "x.*")


def referred(docs: DataFrame, key: str = "path") -> DataFrame:
    """:func:`linked` articles with the lists ``cited`` and ``retracted``, in order: how the works are named that the edges to them lead to."""

    def named(id_: Column, said: dict[str, Column], kind: Column) -> Column:
        value = {k: F.nullif(F.trim(c), F.lit("")) for k, c in said.items()}
        return F.struct(id_.alias("id"), value["doi"].alias("doi"), value["pmid"].alias("pmid"), value["uri"].alias("url"), kind.alias("work_type"))

    rooted = _rooted(docs, key)
    gone = F.filter(F.transform("related", lambda x, i: F.struct((i + 1).alias("n"), x["link"].alias("link"), x["href"].alias("href"))), lambda x: x["href"].isNotNull())
    rooted = rooted.withColumns({
        "cited": F.transform("citation", lambda c: named(_below("reference", c["id"]), _cited_ids(c), ids.work_type(c["kind"]))),
        "retracted": F.transform(gone, lambda x: named(_below("retracted", x["n"]), _gone_ids(x), F.lit("Expression"))),
    })
    return linked(rooted, "article", key)


#: The fields of what :func:`cited_edges` reads of articles.
CITED = (*POINTED, "citation.source", "citation.people")


def cited_edges(docs: DataFrame, key: str = "path") -> DataFrame:
    """(doc, type, source, target, name, role, count, paragraphs): the edges between articles and what they cite, its journals and its people.

    ``name`` is the target's where that is a journal or a person, ``count`` and ``paragraphs`` are of the pointers that denote a
    citation. Made of each article's row: articles are read once and nothing is shuffled.
    """
    docs = _rooted(docs, key).withColumn("refs", F.transform("citation", lambda c: F.struct(c["id"].alias("id"), c["list"].alias("list"))))
    names = F.transform("refs", lambda r: r["id"])
    # The ends' places first, as they stand more than once below.
    placed = F.transform("mark", lambda m: F.struct(m["paragraph"].alias("paragraph"), m["rids"].alias("rids"), m["last"].alias("last"), _place(names, m["first"]).alias("low"), _place(names, m["last"]).alias("high")))
    docs = docs.withColumn("mark", placed)
    denoted = F.transform("mark", lambda m: F.transform(F.coalesce(_named(F.col("refs"), m["rids"], m["last"], m["low"], m["high"]), F.array().cast("array<string>")), lambda r: F.struct(r.alias("rid"), m["paragraph"].alias("paragraph"))))
    docs = docs.withColumn("denoted", F.flatten(denoted))
    seen = F.transform("citation", lambda c: F.struct(
        _below("reference", c["id"]).alias("ref"), c["source"].alias("source"), c["people"].alias("people"),
        F.sort_array(F.transform(F.filter("denoted", lambda d: d["rid"] == c["id"]), lambda d: d["paragraph"])).alias("paragraphs"),
    ))
    docs = docs.select("doc", "root", F.explode(seen).alias("x")).select("doc", "root", "x.*")
    none = F.lit(None).cast("string")

    def edge(type_: str, source: Column, target: Column, name: Column = none, role: Column = none, cited: bool = False) -> Column:
        count, paragraphs = (F.size("paragraphs").cast("long"), F.array_join(F.transform("paragraphs", lambda p: p.cast("string")), " ")) if cited else (F.lit(None).cast("long"), none)
        return F.struct(F.lit(type_).alias("type"), source.alias("source"), target.alias("target"), F.nullif(name, F.lit("")).alias("name"), F.nullif(role, F.lit("")).alias("role"), count.alias("count"), F.nullif(paragraphs, F.lit("")).alias("paragraphs"))

    ref = F.col("ref")
    journal = F.array(edge("journal", ref, F.concat_ws(":", ref, F.lit("journal")), F.col("source")))
    people = F.transform("people", lambda p, i: edge("contributor", ref, F.concat_ws(":", ref, F.lit("contributor"), (i + 1).cast("string")), p["surname"], p["role"]))
    each = F.concat(F.array(edge("cites", F.col("root"), ref, cited=True)), F.when(F.col("source").isNotNull(), journal).otherwise(F.slice(journal, 1, 0)), people)
    return docs.select("doc", F.explode(each).alias("x")).select("doc", "x.*")


def node_parameters(docs: DataFrame, key: str = "path") -> DataFrame:
    """Every article with the same fields, empty where there is nothing; its people by role, joined by semicolons."""
    docs = _rooted(docs, key)

    def people(role: str) -> Column:
        own = F.filter("contributor", lambda c: (c["role"] == role) & c["surname"].isNotNull())
        return F.array_join(F.transform(own, lambda c: F.concat_ws(", ", c["surname"], c["given"])), ";")

    fields = {k: F.col(k) for k in ("title", "volume", "issue", "year", "month")} | {"publisher_name": F.col("publisher"), "source": F.col("journal"), "ctype": F.col("kind"), "author": people("author"), "editor": people("editor")}
    return docs.select("doc", F.col("root").alias("id"), *[F.coalesce(c, F.lit("")).alias(k) for k, c in fields.items()])
