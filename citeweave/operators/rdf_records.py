"""Whole records as quads: organisations, journals, people, articles and their citations.

Each kind of entity is a projection of a record table of :mod:`citeweave.operators.records`;
what refers to another entity has its URI already (:func:`uris`, then ``dereferenced``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeweave.functions import dates, ids, text
from citeweave.operators import deref, rdf
from citeweave.session import materialize

# The vocabularies, and the words of minted paths and labels below.
_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
_LABEL, _VALUE = "http://www.w3.org/2000/01/rdf-schema#label", "http://www.w3.org/1999/02/22-rdf-syntax-ns#value"
_FABIO, _FRBR, _PRISM = "http://purl.org/spar/fabio/", "http://purl.org/vocab/frbr/core#", "http://prismstandard.org/namespaces/basic/2.0/"
_DC, _FOAF, _PRO = "http://purl.org/dc/terms/", "http://xmlns.com/foaf/0.1/", "http://purl.org/spar/pro/"
_CITO, _BIRO, _LIST = "http://purl.org/spar/cito/", "http://purl.org/spar/biro/", "http://purl.org/co/"
_ORG, _SKOS, _VCARD = "http://www.w3.org/ns/org#", "http://www.w3.org/2004/02/skos/core#", "http://www.w3.org/2006/vcard/ns#"
_SORT, _XSD = "http://open.vocab.org/terms/sortLabel", "http://www.w3.org/2001/XMLSchema#"


def _path(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _work_uri(id_: Column, doi: Column, isbn: Column, pmid: Column, url: Column, work_type: Column) -> tuple[Column, Column]:
    """A work's URI and its tail, by which what belongs to it is named: address, DOI, ISBN, number, else own id."""
    web = F.when(work_type.isin("WebPage", "WebSite"), url)
    doi = ids.doi_uri_part(doi)
    own = F.sha1(id_.cast("binary"))
    part = F.coalesce(_path(":web/", F.url_encode(web)), _path(":doi/", doi), _path(":isbn/", isbn), _path(":pmid/", pmid), _path("/", own))
    uri = F.coalesce(web, _path("http://dx.doi.org/", doi), _path("urn:isbn:", isbn), _path("id/expression:pmid/", pmid), _path("id/expression/", own))
    return uri, part


def article_uri(df: DataFrame) -> DataFrame:
    """Articles with ``uri`` and ``part``, its tail, by which what belongs to it is named: address, DOI, ISBN, number, else own id."""
    isbn = F.col("isbn") if "isbn" in df.columns else F.lit(None).cast("string")
    uri, part = _work_uri(F.col("id"), F.col("doi"), isbn, F.col("pmid"), F.col("url"), F.col("work_type"))
    return df.withColumns({"uri": uri, "part": part})


def referred_uris(df: DataFrame, works: str, refs: str) -> DataFrame:
    """``refs``: the URIs of the list of works ``works``, structs of id, doi, pmid, url and work_type.

    As :func:`citeweave.operators.records.dereferenced` by :func:`uris`, for records that have what they refer to with them:
    of works with one id the least URI is all theirs.
    """
    none = F.lit(None).cast("string")
    df = df.withColumn(refs, F.transform(works, lambda w: F.struct(w["id"].alias("id"), _work_uri(w["id"], w["doi"], none, w["pmid"], w["url"], w["work_type"])[0].alias("uri"))))
    twice = F.size(F.array_distinct(F.transform(refs, lambda w: w["id"]))) < F.size(refs)
    least = F.transform(refs, lambda w: F.array_min(F.transform(F.filter(refs, lambda x: x["id"] == w["id"]), lambda x: x["uri"])))
    return df.withColumn(refs, F.when(twice, least).otherwise(F.transform(refs, lambda w: w["uri"])))


def journal_uri(df: DataFrame) -> DataFrame:
    """Journals with ``uri`` and ``part``: by ISSN, else by the abbreviation's or name's slug; null for one without any."""
    slug = text.slug(F.coalesce("abbreviation", "name"))
    return df.withColumns({"uri": F.coalesce(_path("urn:issn:", F.col("issn")), _path("id/journal/", slug)), "part": F.coalesce(_path("issn/", F.col("issn")), _path("journal/", slug))})


def organisation_uri(df: DataFrame, order: str = "id") -> DataFrame:
    """Organisations with ``uri`` and ``part``: the slug of name or address and the organisation's number among those of that slug."""
    slug = F.coalesce(F.nullif(text.slug(F.coalesce("name", "address")), F.lit("")), F.lit("unknown"))
    rows = deref.numbered(df.withColumn("_slug", slug), "_slug", order)
    part = F.concat_ws("-", "_slug", F.col("n").cast("string"))
    return rows.withColumns({"uri": _path("id/org/", part), "part": part}).drop("_slug", "n")


def uris(*named: DataFrame) -> DataFrame:
    """(id, uri) of tables that have both."""
    return reduce(DataFrame.unionByName, [d.where("uri IS NOT NULL").select("id", "uri") for d in named]).groupBy("id").agg(F.min("uri").alias("uri"))


def organisation_quads(df: DataFrame) -> DataFrame:
    """Organisations with their labels, and their addresses as nodes of their own."""
    uri, graph = F.col("uri"), _path("graph/org/", F.col("part"))
    address = F.when(F.col("address").isNotNull(), _path(uri, "/address"))
    own = {_TYPE: rdf.iri(F.lit(_ORG + "Organization")), _SKOS + "prefLabel": rdf.literal(F.col("name")), _LABEL: rdf.literal(F.col("name")), _VCARD + "adr": rdf.iri(address)}
    return rdf.quads_about(df, [(uri, own), (address, {_TYPE: rdf.iri(F.lit(_VCARD + "Address")), _LABEL: rdf.literal(F.col("address"))})], graph)


def journal_quads(df: DataFrame) -> DataFrame:
    """Journals; ``publisher`` is a URI or null."""
    graph = _path("graph/", F.col("part"))
    values = {_FABIO + "hasNationalLibraryOfMedicineJournalId": "nlm_id"} if "nlm_id" in df.columns else {}
    values |= {_DC + "identifier": "abbreviation", _PRISM + "issn": "issn", _PRISM + "eIssn": "eissn", _DC + "title": "name"}
    own = {_TYPE: rdf.iri(F.lit(_FABIO + "Journal")), _DC + "publisher": rdf.iri(F.col("publisher"))} | {p: rdf.literal(F.col(c)) for p, c in values.items()}
    return rdf.quads(df, F.col("uri"), own, graph).distinct()


def article_quads(df: DataFrame) -> DataFrame:
    """Articles, nested in issue, volume and journal; ``journal_uri`` and ``journal_part`` are the journal's, or null."""
    uri, part, graph = F.col("uri"), F.col("part"), _path("graph/expression", F.col("part"))
    form, abstract = _path("id/manifestation", part), _path("id/abstract", part)
    date = F.when(F.col("year").rlike(r"^\d{4}$"), dates.iso_date(F.col("year"), F.col("month"), F.col("day")))
    volume = _path("id/journal/", F.col("journal_part"), "/", text.slug(F.col("volume")))
    issue = F.when(volume.isNotNull(), _path(volume, "/", text.slug(F.col("issue"))))
    values = {_DC + "title": "title", _PRISM + "doi": "doi", _FABIO + "hasPubMedCentralId": "pmc", _FABIO + "hasPubMedId": "pmid"} | ({_PRISM + "isbn": "isbn"} if "isbn" in df.columns else {})
    own = {_TYPE: rdf.iri(F.concat(F.lit(_FABIO), F.coalesce("work_type", F.lit("Expression")))), _FRBR + "embodiment": rdf.iri(form)} | {p: rdf.literal(F.col(c)) for p, c in values.items()}
    own |= {_DC + "published": rdf.literal(date, _XSD + "date"), _PRISM + "publicationDate": rdf.literal(F.concat(date, F.lit("T00:00:00Z")), _XSD + "dateTime"), _FRBR + "part": rdf.iri(F.when(F.col("abstract").isNotNull(), abstract))}
    said = [
        (uri, own),
        (form, {_TYPE: rdf.iri(F.lit(_FABIO + "Manifestation")), _PRISM + "startingPage": rdf.literal(F.col("page_start")), _PRISM + "endingPage": rdf.literal(F.col("page_end"))}),
        (F.when(F.col("abstract").isNotNull(), abstract), {_TYPE: rdf.iri(F.lit(_FABIO + "Abstract")), _VALUE: rdf.literal(F.col("abstract")), _DC + "title": rdf.literal(F.lit("Abstract")), _LABEL: rdf.literal(_path('Abstract for "', F.col("title"), '"'))}),
        *_web(uri),
        (F.col("journal_uri"), {_FRBR + "part": rdf.iri(F.coalesce(volume, uri))}),
        (volume, {_TYPE: rdf.iri(F.lit(_FABIO + "JournalVolume")), _PRISM + "volume": rdf.literal(F.col("volume")), _FRBR + "part": rdf.iri(F.coalesce(issue, uri))}),
        (issue, {_TYPE: rdf.iri(F.lit(_FABIO + "JournalIssue")), _PRISM + "issueIdentifier": rdf.literal(F.col("issue")), _FRBR + "part": rdf.iri(uri)}),
    ]
    return rdf.quads_about(df, said, graph)


def _web(uri: Column) -> list[tuple[Column, dict[str, Column]]]:
    """What is said of addresses: a work that is a page is a document; the address of any other is a page or, at a site's root, a site about the work."""
    url, work = F.col("url"), F.coalesce("work_type", F.lit("Expression"))
    own = work.isin("WebPage", "WebSite") & url.isNotNull()
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    kind, other = F.when(path == "/", "WebSite").otherwise("WebPage"), F.when(url != uri, url)
    document = {_TYPE: rdf.iri(F.lit(_FOAF + "Document"))}
    about = {_TYPE: rdf.iri(F.concat(F.lit(_FABIO), kind)), _FOAF + "primaryTopic": rdf.iri(uri)}
    return [(F.when(own, uri), document), (other, about), (other, document), (uri, {_FOAF + "primaryTopicOf": rdf.iri(other)})]


def person_quads(rows: DataFrame) -> DataFrame:
    """People in their roles. rows: an article's uri and part, role, position from 1, name, surname, given, style, affiliation (a URI or null).

    Where a column ``entity`` isn't null, an entity with quads of its own has the role, and nothing is said of it here.
    """
    graph = _path("graph/expression", F.col("part"))
    person = _path("graph/person", F.col("part"), "/", F.col("role"), "/", F.col("position").cast("string"))
    role = F.concat(person, F.lit("/role"))
    unsaid = F.when(F.col("entity").isNull(), person) if "entity" in rows.columns else person
    whole = F.col("surname").isNotNull() & F.col("given").isNotNull()
    shown, sorted_by = text.display_name(F.col("given"), F.col("surname"), F.col("style"))
    shown, sorted_by = F.when(whole, shown).otherwise(F.col("name")), F.when(whole, sorted_by).otherwise(F.col("name"))
    made = F.when(F.col("role") == "author", rdf.iri(person))
    own = {_TYPE: rdf.iri(F.lit(_FOAF + "Person")), _LABEL: rdf.literal(shown), _FOAF + "name": rdf.literal(shown), _SORT: rdf.literal(F.when(sorted_by != shown, sorted_by))}
    held = {_TYPE: rdf.iri(F.lit(_PRO + "RoleInTime")), _PRO + "withRole": rdf.iri(F.concat(F.lit(_PRO), F.col("role"))), _PRO + "withAffiliation": rdf.iri(F.col("affiliation"))}
    article = {_DC + "creator": made, _DC + "contributor": F.when(made.isNull(), rdf.iri(person)), _PRO + "isRelatedToRoleInTime": rdf.iri(role)}
    return rdf.quads_about(rows, [(unsaid, own), (person, {_PRO + "holdsRoleInTime": rdf.iri(role)}), (role, held), (F.col("uri"), article)], graph)


def citation_quads(df: DataFrame) -> DataFrame:
    """Reference lists in order, and retractions. df: an article's uri, part and title, and the lists ``cites`` and ``retracts`` of URIs."""
    graph, where = _path("graph/ref-list", F.col("part")), _path("id/ref-list", F.col("part"))
    both = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("cites", "retracts")])
    n, pos, to = F.greatest(F.size("cites"), F.lit(0)), F.col("pos"), F.col("to")
    each = df.select("uri", "part", "title", n.alias("n"), F.posexplode(both).alias("pos", "to")).withColumn("pos", pos + 1)

    def item(n: Column) -> Column:
        return _path(where, "/", n.cast("string"))

    cited, start, end = pos <= F.col("n"), (pos == 1) & (pos <= F.col("n")), pos == F.col("n")
    own = {_TYPE: rdf.iri(F.lit(_BIRO + "ReferenceList")), _LIST + "size": rdf.literal(F.col("n"), _XSD + "int"), _DC + "title": rdf.literal(F.lit("References")), _LABEL: rdf.literal(F.concat(F.lit('Reference list for "'), F.col("title"), F.lit('"')))}
    said = [
        (F.when(start, where), own), (F.when(start, F.col("uri")), {_FRBR + "part": rdf.iri(where)}),
        (F.col("uri"), {_CITO + "cites": rdf.iri(F.when(cited, to)), _CITO + "retracts": rdf.iri(F.when(~cited, to))}),
        (F.when(cited, where), {_LIST + "item": rdf.iri(item(pos)), _LIST + "firstItem": rdf.iri(F.when(start, item(pos))), _LIST + "lastItem": rdf.iri(F.when(end, item(pos)))}),
        (F.when(cited, item(pos)), {_TYPE: rdf.iri(F.lit(_LIST + "Item")), _LIST + "itemContent": rdf.iri(to), _LIST + "nextItem": rdf.iri(F.when(~end, item(pos + 1)))}),
    ]
    return rdf.quads_about(each, said, graph)


PEOPLE = ("author", "editor", "translator")
_ORGANISATION, _JOURNAL = ["name", "address"], ["name", "abbreviation", "nlm_id", "issn", "eissn", "publisher"]
_REFERENCES = ("journal", "publisher")
_ARTICLE = "title year month day volume issue doi pmid pmc isbn url work_type abstract page_start page_end journal".split()


KINDS = ("organisations", "journals", "articles", "people", "citations")


def export(organisations: DataFrame, journals: DataFrame, articles: DataFrame, people: DataFrame, kinds: tuple[str, ...] = KINDS) -> dict[str, DataFrame]:
    """Quads of merged records: ``organisations``, ``journals``, ``articles``, ``people``, ``citations``, those of ``kinds``.

    Records have id, group and source, and any of their kind's fields; people, which are put in where articles refer to
    them, need no group. Each kind is merged field by field (:func:`deref.voted`) after its references are followed, and
    what one kind is called is known to the next: organisations, journals, articles, what articles cite. Fields that can't
    refer to anything are merged as columns (:func:`deref.elected`); nothing is followed or merged that ``kinds`` doesn't need.
    """

    def valued(records: DataFrame, fields: list[str], uris: DataFrame, known: list[DataFrame] = ()) -> DataFrame:
        return deref.valued(deref.followed(deref.shredded(records, "id", fields), deref.leaves_of([records, *known]), uris))

    def merged(records: DataFrame, fields: list[str], lists: tuple[str, ...], uris: DataFrame, known: list[DataFrame] = ()) -> DataFrame:
        names = [f for f in (*fields, *lists) if f in records.columns]
        return materialize(deref.voted(valued(records, names, uris, known), records.select("id", "group", "source"), lists), "merged")

    def wide(records: DataFrame, fields: list[str], uris: DataFrame, extra: tuple[str, ...] = (), known: list[DataFrame] = ()) -> DataFrame:
        """(group, fields) of the groups that say anything in the fields or in ``extra``."""
        there = [f for f in fields if f in records.columns]
        linked = [f for f in there if f in _REFERENCES or deref.refers(records.schema[f].dataType)]
        plain = [f for f in there if f not in linked]
        said = deref.saying(records, [*there, *[f for f in extra if f in records.columns]])
        out = deref.elected(said, plain)
        if linked:
            own = deref.widened(merged(records, linked, (), uris, known), linked, references=_REFERENCES)
            out = out.join(own, "group", "left")
        return absent(out, *fields).select("group", *fields)

    def named(records: DataFrame, rows: DataFrame) -> DataFrame:
        return records.select("id", "group").join(rows.where("uri IS NOT NULL").select("group", "uri"), "group").select("id", "uri")

    def absent(rows: DataFrame, *fields: str) -> DataFrame:
        return rows.withColumns({f: F.lit(None).cast("string") for f in fields if f not in rows.columns})

    none = organisations.sparkSession.createDataFrame([], "id string, uri string")
    out = {}
    orgs = materialize(organisation_uri(wide(organisations, _ORGANISATION, none), "group"), "organisations")
    out["organisations"] = organisation_quads(orgs)
    uris = named(organisations, orgs)
    periodicals = materialize(journal_uri(wide(journals, _JOURNAL, uris)), "journals")
    out["journals"] = journal_quads(absent(periodicals, "nlm_id"))
    if set(kinds) & {"articles", "people", "citations"}:
        uris = materialize(uris.unionByName(named(journals, periodicals)), "uris")
        roles = tuple(r for r in PEOPLE if r in articles.columns)
        lists = tuple(c for c in ("cites", "retracts") if c in articles.columns and "citations" in kinds)
        # What names an article is needed by all kinds.
        fields = _ARTICLE if "articles" in kinds else [f for f in _ARTICLE if f in ("title", "doi", "pmid", "isbn", "url", "work_type")]
        articles = materialize(articles.select("id", "group", "source", *[f for f in (*_ARTICLE, *roles, *lists) if f in articles.columns]), "records")
        known = [people.select(*[c for c in people.columns if c not in ("group", "source")])]
        body = articles.drop(*lists)
        works = wide(body, fields, uris, (*_ARTICLE, *roles), known).withColumn("id", F.col("group"))
        if "articles" in kinds:
            parts = periodicals.where("uri IS NOT NULL").groupBy(F.col("uri").alias("journal")).agg(F.min("part").alias("journal_part"))
            works = works.join(parts, "journal", "left").withColumn("journal_uri", F.col("journal"))
        works = materialize(article_uri(works), "works")
        if "articles" in kinds:
            out["articles"] = article_quads(works)
        if "people" in kinds:
            held = deref.items(merged(body, [], roles, uris, known), roles, ["name", "surname", "given", "style", "affiliated"])
            held = held.join(works.select("group", F.col("uri").alias("work"), "part"), "group").withColumn("role", F.col("field"))
            held = held.select(F.col("work").alias("uri"), "part", "role", "position", "name", "surname", "given", F.coalesce("style", F.lit("western")).alias("style"), F.col("affiliated").alias("affiliation"), F.col("uri").alias("entity"))
            out["people"] = person_quads(held)
        if "citations" in kinds:
            citing = articles.select("id", "group", "source", *lists)
            cited = deref.longest(valued(citing, list(lists), uris.unionByName(named(articles, works))), citing, lists)
            cited = works.select("group", "uri", "part", "title").join(cited, "group")
            cited = cited.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) if c in lists else F.array().cast("array<string>") for c in ("cites", "retracts")})
            out["citations"] = citation_quads(cited)
    return {k: v for k, v in out.items() if k in kinds}
