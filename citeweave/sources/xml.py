"""Article and metadata XML as records: one parse a document, in tasks."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import cached_property

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

IDENTIFIER = "array<struct<type:string,id:string,canonical:string>>"
PERSON = "array<struct<lastname:string,forenames:string,affiliation:array<string>>>"
CITATION = "array<struct<cite_order:int,kind:string,title:string,source:string,year:string,volume:string,firstpage:string,lastpage:string,authors:string,identifier:array<struct<type:string,id:string,canonical:string>>,text:string,id:string,publisher:string,list:int,people:array<struct<role:string,surname:string,given:string,style:string>>>>"
SECTION = "array<struct<path:string,title:string,kind:string,place:int>>"
MARK = "array<struct<section:string,paragraph:int,place:int,text:string,first:string,last:string,rids:array<string>>>"
POINTER = "array<struct<paragraph:int,rids:array<string>>>"
CONTRIBUTOR = "array<struct<role:string,surname:string,given:string,style:string,collab:string,rids:array<string>>>"
ARTICLE = (
    f"title string, abstract string, journal string, publisher string, volume string, issue string, firstpage string, lastpage string, "
    f"year string, month string, day string, keyword array<string>, identifier {IDENTIFIER}, author {PERSON}, citation {CITATION}, pointer {POINTER}, "
    f"kind string, heading string, license string, journal_abbr string, issn string, eissn string, publisher_place string, "
    f"contributor {CONTRIBUTOR}, place array<struct<id:string,address:string>>, related array<struct<link:string,href:string>>, section {SECTION}, mark {MARK}, error string"
)
#: The first of these kinds of date that an article has is its date.
DATES = ("pmc-release", "ppub", "epub", "collection")


#: What a text declares: prefixes, an empty one where it is the default namespace.
_DECLARED = re.compile(rb"xmlns:?([^\s=]*)")
_TYPE = re.compile(rb"<!DOCTYPE[^>\[]*(\[[^\]]*\])?[^>]*>")


def _spaced(data: bytes) -> bool:
    """Whether elements of a text may have namespaces: a default one is declared, or a declared prefix begins a tag."""
    return any(not p or b"<" + p + b":" in data for p in {*_DECLARED.findall(data), b"xml"})


def _parse(data: str | bytes) -> ET.Element:
    """The tree without namespaces; a document type is dropped, and entities it would declare with it. Bytes are UTF-8, whatever they declare."""
    data = data.encode() if isinstance(data, str) else data
    typed = b"<!DOCTYPE" in data
    if typed:
        data = _TYPE.sub(b"", data, count=1)
    parser = ET.XMLParser(encoding="utf-8")
    parser.feed(data)
    tree = parser.close()
    if (typed and b"<!DOCTYPE" in data) or _spaced(data):  # entities of a type that wasn't dropped may hide tags
        for e in tree.iter():
            if isinstance(e.tag, str) and "}" in e.tag:
                e.tag = e.tag.rpartition("}")[2]
    return tree


def _at(e: ET.Element, outer: str, inner: str) -> ET.Element | None:
    """The first ``inner`` in an ``outer`` of an element."""
    for x in e.findall(outer):
        if (found := x.find(inner)) is not None:
            return found
    return None


def full_text(e: ET.Element | None) -> str | None:
    """All text below an element in document order, white space squeezed."""
    if e is None:
        return None
    text = "".join(e.itertext()) if len(e) else e.text
    return " ".join(text.split()) or None if text else None


def first_text(e: ET.Element | None) -> str | None:
    """Only the text before the first child."""
    return None if e is None or not (e.text or "").strip() else " ".join(e.text.split())


def _ids(pairs: list[tuple[str | None, str | None]]) -> list[tuple[str, str, str]]:
    return [(t, i, f"{t}:{i}") for t, i in pairs if t and i]


class _Cited:
    """A reference by its kind: a journal's article, a book or a chapter of it, or anything else."""

    __slots__ = ("ref", "order", "of_list", "_c")

    def __init__(self, ref: ET.Element, order: int, of_list: int):
        self.ref, self.order, self.of_list, self._c = ref, order, of_list, None

    @property
    def c(self) -> ET.Element:
        if self._c is None:
            self._c = next((x for x in self.ref if x.tag in ("mixed-citation", "element-citation", "citation", "nlm-citation")), self.ref)
        return self._c

    def first(self, tag: str) -> str | None:
        return full_text(next(self.c.iter(tag), None))

    def kind(self) -> str | None:
        return self.c.get("publication-type") or self.c.get("citation-type")

    def title(self) -> str | None:
        kind = self.kind()
        if kind == "book":
            return self.first("chapter-title") or self.first("article-title") or self.first("source")
        return self.first("article-title") or self.first("source") or (None if kind == "journal" else self.first("comment"))

    def authors(self) -> str | None:
        """By name, else a group, else as the text has them."""
        names = [" ".join(filter(None, (n.findtext("surname"), n.findtext("given-names")))) for n in self.c.iter("name")]
        names = names or [full_text(x) for tag in ("collab", "string-name", "person-group") for x in self.c.iter(tag)][:1]
        return ", ".join(filter(None, names)) or None

    def identifier(self) -> list[tuple]:
        return _ids([(p.get("pub-id-type"), full_text(p)) for p in self.c.iter("pub-id")])

    def text(self) -> str | None:
        label, text = self.ref.find("label"), full_text(self.c)
        if label is not None and self.c is self.ref and text and label.text:
            text = text.removeprefix(label.text).strip()
        return text

    def people(self) -> list[tuple]:
        groups = [g for g in self.c.findall("person-group") if g.get("person-group-type") is not None]
        return [(g.get("person-group-type"), full_text(n.find("surname")), full_text(n.find("given-names")), n.get("name-style")) for g in groups for n in g.findall("name")]


#: How each field of a citation is read.
_CITED: dict[str, Callable[[_Cited], object]] = {
    "cite_order": lambda c: c.order, "kind": _Cited.kind, "title": _Cited.title, "source": lambda c: c.first("source"), "year": lambda c: c.first("year"), "volume": lambda c: c.first("volume"),
    "firstpage": lambda c: c.first("fpage"), "lastpage": lambda c: c.first("lpage"), "authors": _Cited.authors, "identifier": _Cited.identifier, "text": _Cited.text, "id": lambda c: c.ref.get("id"),
    "publisher": lambda c: c.first("publisher-name"), "list": lambda c: c.of_list, "people": _Cited.people,
}


def _attribute(e: ET.Element, name: str) -> str | None:
    """An attribute, whatever its namespace."""
    return next((v for k, v in e.attrib.items() if k.rpartition("}")[2] == name), None)


class _Read:
    """An article's tree; what several fields are read from is found once."""

    def __init__(self, data: str | bytes):
        tree = _parse(data)
        art = tree if tree.tag == "article" else tree.find(".//article")
        if art is None:
            raise ValueError("no article")
        self.art = art
        meta, journal = _at(art, "front", "article-meta"), _at(art, "front", "journal-meta")
        self.meta = meta if meta is not None else ET.Element("none")
        self.journal = journal if journal is not None else ET.Element("none")

    @cached_property
    def date(self) -> ET.Element:
        dates = {d.get("pub-type") or d.get("date-type"): d for d in self.meta.iter("pub-date")}
        return next((dates[k] for k in DATES if k in dates), next(iter(dates.values()), ET.Element("none")))

    @cached_property
    def issns(self) -> dict[str, str | None]:
        return {(i.get("pub-type") or "ppub"): full_text(i) for i in self.journal.findall("issn")}

    @cached_property
    def refs(self) -> list[tuple[ET.Element, int]]:
        return [(r, of_list) for of_list, x in enumerate(self.art.iter("ref-list"), 1) for r in x.findall("ref")]

    @cached_property
    def body(self) -> tuple[list[tuple], list[tuple]]:
        return _walk(self.art.find("body"))

    def author(self) -> list[tuple]:
        places = {a.get("id"): full_text(a) for a in self.meta.iter("aff")}
        named = [c for c in self.meta.iter("contrib") if c.get("contrib-type", "author") == "author" and c.find("name") is not None]
        return [(c.findtext("name/surname"), c.findtext("name/given-names"), [places[r] for r in _placed(c) if places.get(r)]) for c in named]

    def citations(self, fields: Sequence[Callable[[_Cited], object]]) -> list[tuple]:
        return [tuple([f(c) for f in fields]) for c in (_Cited(r, n, of_list) for n, (r, of_list) in enumerate(self.refs, 1))]

    def pointer(self) -> list[tuple]:
        order = {r.get("id"): n for n, (r, _) in reversed(list(enumerate(self.refs)))}
        return [(n, rids) for n, p in enumerate(self.art.findall("body//p"), 1) if (rids := _pointers(p, order))]

    def contributor(self) -> list[tuple]:
        people = []
        for c in (c for g in self.meta.findall("contrib-group") for c in g.findall("contrib")):
            name = c.find("name")
            own = (name.findtext("surname"), name.findtext("given-names"), name.get("name-style")) if name is not None else (None, None, None)
            people.append((c.get("contrib-type"), *own, full_text(c.find("collab")), _placed(c)))
        return people

    def place(self) -> list[tuple]:
        return [(a.get("id"), full_text(x) if (x := a.find("addr-line")) is not None else full_text(a)) for a in self.meta.iter("aff")]

    def related(self) -> list[tuple]:
        return [(x.get("ext-link-type"), _attribute(x, "href")) for x in self.meta.findall("related-article") if x.get("related-article-type") == "retracted-article"]


def _placed(contrib: ET.Element) -> list[str]:
    """The ids of the places that a contributor names."""
    return [r for x in contrib.findall("xref") if x.get("ref-type") == "aff" for r in (x.get("rid") or "").split()]


#: How each field of an article is read, but its citations.
_FIELDS: dict[str, Callable[[_Read], object]] = {
    "title": lambda a: full_text(_at(a.meta, "title-group", "article-title")), "abstract": lambda a: full_text(a.meta.find("abstract")),
    "journal": lambda a: full_text(next(a.journal.iter("journal-title"), None)), "publisher": lambda a: full_text(_at(a.journal, "publisher", "publisher-name")),
    "volume": lambda a: full_text(a.meta.find("volume")), "issue": lambda a: full_text(a.meta.find("issue")), "firstpage": lambda a: full_text(a.meta.find("fpage")), "lastpage": lambda a: full_text(a.meta.find("lpage")),
    "year": lambda a: full_text(a.date.find("year")), "month": lambda a: full_text(a.date.find("month")), "day": lambda a: full_text(a.date.find("day")),
    "keyword": lambda a: [full_text(k) for k in a.meta.findall("kwd-group/kwd")], "identifier": lambda a: _ids([(i.get("pub-id-type"), full_text(i)) for i in a.meta.findall("article-id")]),
    "author": _Read.author, "pointer": _Read.pointer, "kind": lambda a: a.art.get("article-type"),
    "heading": lambda a: next((full_text(x) for x in a.meta.findall("article-categories/subj-group[@subj-group-type='heading']/subject")), None),
    "license": lambda a: next((v for x in a.meta.findall("permissions/license") if (v := _attribute(x, "href"))), None),
    "journal_abbr": lambda a: full_text(next((x for x in a.journal.findall("journal-id") if x.get("journal-id-type") == "nlm-ta"), None)),
    "issn": lambda a: next((v for k, v in a.issns.items() if k != "epub"), None), "eissn": lambda a: a.issns.get("epub"), "publisher_place": lambda a: full_text(_at(a.journal, "publisher", "publisher-loc")),
    "contributor": _Read.contributor, "place": _Read.place, "related": _Read.related, "section": lambda a: a.body[0], "mark": lambda a: a.body[1], "error": lambda a: None,
}


def _pruned(only: Iterable[str] | None) -> StructType:
    """The fields of an article; of those named alone, and of its citations what is named after a dot."""
    whole = StructType.fromDDL(ARTICLE)
    if only is None:
        return whole
    names = {*only, "error"}
    cited = [f for f in whole["citation"].dataType.elementType.fields if "citation" in names or f"citation.{f.name}" in names]
    if lost := names - {f.name for f in whole} - {f"citation.{f.name}" for f in cited}:
        raise ValueError(f"articles have no {', '.join(sorted(lost))}")
    kept = [StructField("citation", ArrayType(StructType(cited))) if f.name == "citation" else f for f in whole if f.name in names or (f.name == "citation" and cited)]
    return StructType(kept)


def _pointers(p: ET.Element, order: dict[str | None, int]) -> list[str]:
    """References a paragraph points to; between two pointers joined by a dash, all that lie between in the list."""
    out: list[str] = []
    names = list(order)[::-1]  # in the list's order
    last, dash = None, False
    for x in p.iter("xref"):
        if x.get("ref-type") != "bibr":
            continue
        for rid in (x.get("rid") or "").split():
            if dash and last in order and rid in order and order[last] < order[rid]:
                out += names[order[last] + 1 : order[rid]]
            out.append(rid)
            last = rid
        dash = (x.tail or "").strip() in ("-", "–", "—")
    return out


def _bibr(e: ET.Element) -> bool:
    return e.tag == "xref" and e.get("ref-type") == "bibr"


def _walk(body: ET.Element | None) -> tuple[list[tuple], list[tuple]]:
    """The sections of a body and its in-text pointers, in order.

    A section's path numbers it among its siblings, below its parent's path; a pointer outside all sections has the
    path "". A pointer's paragraph is one more than the paragraphs that ended before it, its place the code points of
    text before it. Two pointers with nothing but a hyphen or dash between are one, of a range; what follows a range in
    the same way belongs to none. Pointers in a section's own title are left out.
    """
    sections: list[tuple] = []
    marks: list[tuple] = []
    if body is None:
        return sections, marks
    place, paragraph = len(body.text or ""), 1
    stack = [(body, list(body), 0, "", [0])]  # an element, its children, the next of them, its section's path, its sections so far
    while stack:
        e, children, at, path, count = stack.pop()
        n = len(children)
        while at < n:
            child = children[at]
            at += 1
            tag, text, tail = child.tag, child.text, child.tail
            below, inner = path, count
            if not isinstance(tag, str):  # a comment
                place += len(tail or "")
                continue
            if tag == "title" and e.tag == "sec":
                place += (len("".join(child.itertext())) if len(child) else len(text or "")) + len(tail or "")
                continue
            if tag == "sec":
                count[0] += 1
                below, inner = f"{path}.{count[0]}" if path else str(count[0]), [0]
                sections.append((below, first_text(child.find("title")), child.get("sec-type"), place))
            elif tag == "xref" and child.get("ref-type") == "bibr":
                before = children[at - 2] if at > 1 else None
                if before is None or before.tail not in ("-", "–") or not _bibr(before):
                    after = children[at] if at < n else None
                    if tail in ("-", "–") and after is not None and _bibr(after):
                        marks.append((below, paragraph, place, _spoken(child) + tail + _spoken(after), child.get("rid"), after.get("rid"), []))
                    else:
                        marks.append((below, paragraph, place, _spoken(child), None, None, (child.get("rid") or "").split()))
            if text:
                place += len(text)
            if len(child):
                stack.append((e, children, at, path, count))
                stack.append((child, list(child), 0, below, inner))
                break
            if tag == "p":
                paragraph += 1
            if tail:
                place += len(tail)
        else:
            if e is not body:
                if e.tag == "p":
                    paragraph += 1
                place += len(e.tail or "")
    return sections, marks


def _spoken(e: ET.Element) -> str:
    return " ".join(e.itertext()) if len(e) else e.text or ""


def articles(df: DataFrame, content: str = "content", keep: str = "path", partitions: int | None = None, only: Iterable[str] | None = None) -> DataFrame:
    """Article XML as records; what can't be parsed has only an error.

    ``partitions``: deal the rows to so many tasks first. Files read by Spark are many tasks already; rows behind a small
    shuffle may be one, however long they take to parse. ``only``: the fields to read, ``citation.id`` for one of the
    citations' own; the result has these and ``error``. All documents are parsed whole all the same.
    """
    schema = _pruned(only)
    cited = [_CITED[f.name] for f in schema["citation"].dataType.elementType] if "citation" in schema.names else []
    read = [(lambda a: a.citations(cited)) if n == "citation" else _FIELDS[n] for n in schema.names]
    out = StructType([StructField("k", StringType()), *schema])
    fields = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 500):  # trees and rows of few articles at a time
                rows = []
                keys, texts = batch.column("k")[low : low + 500], batch.column("c")[low : low + 500].cast(pa.binary())
                for key, data in zip(keys.to_pylist(), texts.to_pylist(), strict=True):
                    try:
                        article = _Read(data)
                        rows.append((key, *[f(article) for f in read]))
                    except (ET.ParseError, ValueError, TypeError) as e:
                        rows.append((key, *[None] * (len(read) - 1), str(e)[:200]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    rows = df.select(F.col(keep).alias("k"), F.col(content).cast("string").alias("c"))
    rows = rows.repartition(partitions, "k") if partitions else rows
    return rows.mapInArrow(run, out).withColumnRenamed("k", keep)


PREPRINT = f"id string, title string, abstract string, doi string, license string, comments string, categories string, journal_ref string, identifier {IDENTIFIER}, author {PERSON}"


def preprints(df: DataFrame, content: str = "content") -> DataFrame:
    """Preprint metadata XML as records."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data in pdf["c"]:
                try:
                    t = _parse(data)
                except (ET.ParseError, TypeError):
                    continue
                get = {k: full_text(t.find(f".//{k}")) for k in ("id", "title", "abstract", "doi", "license", "comments", "categories", "journal-ref")}
                people = [(a.findtext("keyname"), a.findtext("forenames"), [full_text(x) for x in a.findall("affiliation")]) for a in t.iter("author")]
                rows.append((*get.values(), _ids([("arxiv", get["id"]), ("doi", get["doi"])]), people))
            yield pd.DataFrame(rows, columns=["id", "title", "abstract", "doi", "license", "comments", "categories", "journal_ref", "identifier", "author"])

    return df.select(F.col(content).cast("string").alias("c")).mapInPandas(run, PREPRINT)


DOCSUM = (
    "pmid string, pmc string, doi string, pii string, title string, source string, volume string, issue string, first_page string, last_page string, "
    "year string, month string, day string, journal struct<name:string,issn:string,eissn:string,abbr:string>, author array<string>"
)


def docsums(df: DataFrame, content: str = "content") -> DataFrame:
    """Summaries of an article service as records, with the people and the journal that they name.

    ``1234-8`` are the pages 1234 to 1238; a summary that can't be parsed is passed over.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for data in pdf["c"]:
                try:
                    t = _parse(data)
                except (ET.ParseError, TypeError):
                    continue
                t = t if t.tag == "DocSum" else t.find(".//DocSum")
                if t is None:
                    continue
                item = {i.get("Name"): full_text(i) for i in t.findall("Item") if not len(i)}
                ids = {i.get("Name"): full_text(i) for i in t.findall("Item[@Name='ArticleIds']/Item")}
                people = [full_text(i) for i in t.findall("Item[@Name='AuthorList']/Item[@Name='Author']")]
                date = [*(item.get("PubDate") or "").split("-"), "", ""][:3]
                pages = (item.get("Pages") or "").split("-")
                last = pages[0][: max(0, len(pages[0]) - len(pages[-1]))] + pages[-1]
                journal = (item.get("FullJournalName"), item.get("ISSN"), item.get("ESSN"), item.get("Source"))
                number = (ids.get("pmc") or "").removeprefix("PMC") or None
                rows.append((
                    ids.get("pubmed") or t.findtext("Id"), number, ids.get("doi"), ids.get("pii"), *[item.get(k) for k in ("Title", "Source", "Volume", "Issue")],
                    pages[0] or None, last or None, *[x or None for x in date], journal if any(journal) else None, [p for p in people if p],
                ))
            yield pd.DataFrame(rows, columns=names)

    names = [f.name for f in df.sparkSession.createDataFrame([], DOCSUM).schema]
    return df.select(F.col(content).cast("string").alias("c")).mapInPandas(run, DOCSUM)


def nodes_and_edges(df: DataFrame, content: str = "content", keep: str = "path") -> tuple[DataFrame, DataFrame]:
    """Node and edge XML as two tables: nodes(doc, id, type, data), edges(doc, type, source, target, data)."""
    schema = "doc string, is_edge boolean, id string, type string, source string, target string, data map<string,string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, data in zip(pdf["k"], pdf["c"], strict=True):
                try:
                    t = _parse(data)
                except (ET.ParseError, TypeError):
                    continue
                for e in t:
                    if e.tag in ("node", "edge"):
                        rows.append((key, e.tag == "edge", e.get("id"), e.get("type"), e.get("source"), e.get("target"), {d.get("key"): full_text(d) for d in e.findall("data")}))
            yield pd.DataFrame(rows, columns=["doc", "is_edge", "id", "type", "source", "target", "data"])

    rows = df.select(F.col(keep).alias("k"), F.col(content).cast("string").alias("c")).mapInPandas(run, schema)
    return rows.where("NOT is_edge").select("doc", "id", "type", "data"), rows.where("is_edge").select("doc", "type", "source", "target", "data")


def reference_string(kind, authors, title, source, volume, pages, year, publisher=None):
    """A reference as people write it, by its kind."""
    journal = F.concat_ws(", ", authors, title, F.concat_ws(" ", source, volume), pages, F.concat(F.lit("("), year, F.lit(")")))
    book = F.concat_ws(", ", authors, F.coalesce(source, title), publisher if publisher is not None else F.lit(None), F.concat(F.lit("("), year, F.lit(")")))
    return F.when(kind == "journal", journal).when(kind == "book", book).otherwise(F.concat_ws(", ", authors, title, source, year))
