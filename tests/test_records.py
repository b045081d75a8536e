"""Articles as nodes, edges, records and quads, by hand."""

import pytest
from pyspark.sql import functions as F

from citeweave.operators import enrich, graph, match, rdf_records, records
from citeweave.plans import registry
from citeweave.session import materialize
from citeweave.sources import projection, sinks, xml

ARTICLE = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "x" "y.dtd">
<article xmlns:xlink="http://www.w3.org/1999/xlink" article-type="retraction"><front>
<journal-meta><journal-id journal-id-type="nlm-ta">J. Odd</journal-id><journal-title-group><journal-title>Journal of Odd</journal-title></journal-title-group>
<issn pub-type="ppub">1111-2222</issn><issn pub-type="epub">3333-4444</issn><publisher><publisher-name>House</publisher-name><publisher-loc>Town</publisher-loc></publisher></journal-meta>
<article-meta><article-id pub-id-type="doi">10.1/a b</article-id><article-id pub-id-type="pmc">77</article-id>
<article-categories><subj-group subj-group-type="heading"><subject>Research Article</subject></subj-group></article-categories>
<title-group><article-title>A <italic>great</italic> title</article-title></title-group>
<contrib-group><contrib contrib-type="author"><name name-style="eastern"><surname>Mao</surname><given-names>Li</given-names></name><xref ref-type="aff" rid="a1 a2"/></contrib>
<contrib contrib-type="author"><collab>The Group</collab></contrib><contrib contrib-type="editor"><name><surname>Ed</surname><given-names>It</given-names></name></contrib></contrib-group>
<aff id="a1"><addr-line>First St</addr-line></aff><aff id="a2">Second St</aff>
<pub-date pub-type="ppub"><month>3</month><year>2004</year></pub-date><volume>5 B</volume><issue>6</issue><fpage>12</fpage><lpage>34</lpage><abstract><p>Short.</p></abstract>
<permissions><license xlink:href="http://l"/></permissions><related-article related-article-type="retracted-article" ext-link-type="uri" xlink:href="info:doi/10.9/z"/>
<related-article related-article-type="retracted-article" ext-link-type="pubmed" xlink:href="555"/><related-article related-article-type="other" xlink:href="no"/></article-meta></front>
<body><p>As shown <xref ref-type="bibr" rid="r1">1</xref>.</p></body>
<back><ref-list><ref id="r1"><mixed-citation publication-type="book"><name><surname>Au</surname><given-names>T</given-names></name><chapter-title>Chapter</chapter-title><source>Book</source><publisher-name>Pub</publisher-name><year>1999</year></mixed-citation></ref>
<ref id="r2"><citation>Someone, Thing, 2001, doi 10.1234/xy. http://a.b/c</citation></ref><ref id="r3"><element-citation publication-type="journal"><collab>Group</collab><source>Nature</source><pub-id pub-id-type="pmid">9</pub-id></element-citation></ref></ref-list></back></article>"""


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame([("f1", ARTICLE), ("f2", "<broken"), ("f3", "<article><front/></article>")], "path string, content string")
    return xml.articles(df).coalesce(1).cache()


def test_nodes_and_edges_of_an_article(docs):
    nodes = {r.id: r for r in projection.nodes(docs).where("doc = 'f1'").collect()}
    root = "pmc:77"
    assert set(nodes) == {root} | {f"{root}:{x}" for x in ("journal", "publisher", "contributor:1", "contributor:2", "contributor:3", "affiliation:a1", "affiliation:a2", "reference:r1", "reference:r2", "reference:r3", "reference:r1:journal", "reference:r3:journal", "in-text-reference-pointer:1", "retracted:1", "retracted:2")}
    own = nodes[root].data
    assert (own["title"], own["ctype"], own["fabio_type"], own["author"], own["license"], own["source"]) == ("A great title", "retraction", "JournalArticle", "Mao Li, The Group", "http://l", "First St")
    assert (own["reference_count"], own["in_text_reference_pointer_count"], own["doi"], own["year"], own["month"]) == ("3", "1", "10.1/a b", "2004", "3") and "day" not in own
    assert nodes[f"{root}:journal"].data == {"nlm_ta": "J. Odd", "issn": "1111-2222", "eissn": "3333-4444", "title": "Journal of Odd"}
    assert [nodes[f"{root}:contributor:{i}"].type for i in (1, 2, 3)] == ["person", "organization", "person"]
    assert nodes[f"{root}:contributor:1"].data == {"surname": "Mao", "given-names": "Li", "name-style": "eastern"}
    book, text, article = (nodes[f"{root}:reference:r{i}"].data for i in (1, 2, 3))
    assert (book["title"], book["source"], book["publisher"], book["fabio_type"], book["author"]) == ("Chapter", "Book", "Pub", "Book", "Au T")
    assert (text["doi"], text["year"], text["uri"], text["ctype"]) == ("10.1234/xy", "2001", "http://a.b/c", "none")
    assert (article["title"], article["author"], article["pmid"]) == ("Nature", "Group", "9")
    assert nodes[f"{root}:retracted:1"].data["doi"] == "10.9/z" and nodes[f"{root}:retracted:2"].data["pmid"] == "555"
    edges = {(r.type, r.source, r.target) for r in projection.edges(docs).where("doc = 'f1'").collect()}
    assert ("affiliation", f"{root}:contributor:1", f"{root}:affiliation:a2") in edges and ("publisher", f"{root}:journal", f"{root}:publisher") in edges
    assert len(edges) == 1 + 1 + 3 + 2 + 3 + 2 + 2 + 1
    cites = {r.target[-2:]: r.data for r in projection.edges(docs).where("type = 'cites'").collect()}
    assert cites["r1"] == {"position": "1", "count": "1", "paragraphs": "1"} and cites["r2"] == {"position": "2", "count": "0"}
    assert {r.id for r in projection.nodes(docs).where("doc = 'f3'").collect()} == {"file:f3", "file:f3:journal"}
    uniform = projection.node_parameters(docs).where("doc = 'f1'").first()
    assert (uniform.author, uniform.editor, uniform.title) == ("Mao, Li", "Ed, It", "A great title")
    ids = docs.where("path = 'f1'").select(projection.id_map(F.col("identifier")).alias("m")).first().m
    assert ids == {"doi": "10.1/a b", "pmc": "77"}
    seen = records.citing_contexts(docs, ["f1", "f9"]).collect()
    assert [(r.paragraph, r.ref, r.title) for r in seen] == [(1, "r1", "Chapter")]


NESTED = """<article><front><article-meta><article-id pub-id-type="pmid">5</article-id></article-meta></front><body>
<p>Out <xref ref-type="bibr" rid="r1">1</xref></p><sec sec-type="intro"><title>In<xref ref-type="bibr" rid="r1">1</xref></title>
<p>a<xref ref-type="bibr" rid="r1 r9">1,9</xref>, <xref ref-type="bibr" rid="r2">2</xref>–<xref ref-type="bibr" rid="r4">4</xref>–<xref ref-type="bibr" rid="r5">5</xref></p>
<sec><title>Deep</title><fig><caption><p>é <xref ref-type="bibr" rid="r4">4</xref>-<xref ref-type="bibr" rid="r2">2</xref></p></caption></fig><!-- no --><sec><p/><p><xref ref-type="fig" rid="f">f</xref><xref ref-type="bibr" rid="r3">3</xref> - <xref ref-type="bibr" rid="r4">4</xref></p></sec></sec></sec>
<sec><p><xref ref-type="bibr" rid="r4">4</xref>-<xref ref-type="bibr" rid="s2">s2</xref><xref ref-type="bibr" rid="r4">4</xref>-<xref ref-type="bibr" rid="nobody">?</xref></p></sec></body>
<back><ref-list><ref id="r1"/><ref id="r2"/><ref id="r3"/><ref id="r4"/><ref id="r5"/></ref-list><sec><ref-list><ref id="s1"/><ref id="s2"/></ref-list></sec></back></article>"""


def test_sections_and_in_text_pointers(spark):
    deep = "<sec>" * 3000 + '<p><xref ref-type="bibr" rid="r1"/></p>' + "</sec>" * 3000
    rows = [("a", NESTED), ("b", f"<article><front/><body>{deep}</body></article>"), ("c", "<article><front/></article>")]
    docs = xml.articles(spark.createDataFrame(rows, "path string, content string"), partitions=3)
    assert docs.rdd.getNumPartitions() == 3
    docs = materialize(docs, "test", 1)
    sections = {r.id: r.data for r in projection.nodes(docs).where("type = 'section' AND doc = 'a'").collect()}
    assert {k: (v.get("title"), v.get("sec-type")) for k, v in sections.items()} == {"pmid:5:section:1": ("In", "intro"), "pmid:5:section:1.1": ("Deep", None), "pmid:5:section:1.1.1": (None, None), "pmid:5:section:2": (None, None)}
    assert docs.where("path = 'b'").select(F.size("section"), F.size("mark")).first() == (3000, 1)
    marks = projection.marks(docs.where("path <> 'b'"))
    seen = [(r.section, r.paragraph, r.text, r.first, r.last, r.rids) for r in marks.orderBy("place").collect()]
    assert seen == [
        ("", 1, "1", None, None, ["r1"]), ("1", 2, "1,9", None, None, ["r1", "r9"]), ("1", 2, "2–4", "r2", "r4", []), ("1.1", 3, "4-2", "r4", "r2", []),
        ("1.1.1", 5, "3", None, None, ["r3"]), ("1.1.1", 5, "4", None, None, ["r4"]), ("2", 6, "4-s2", "r4", "s2", []), ("2", 6, "4-?", "r4", "nobody", []),
    ]
    text = "".join(xml._parse(NESTED).find("body").itertext())
    assert [text[r.place] for r in marks.orderBy("place").collect()] == list("11243444")
    found = [(int(r.id.rsplit(":", 1)[1]), r.rid) for r in projection.denotes(marks).orderBy("id", "rank").collect()]
    assert found == [(1, "r1"), (2, "r1"), (2, "r9"), (3, "r2"), (3, "r3"), (3, "r4"), (5, "r3"), (6, "r4"), (7, "r4"), (7, "r5")]
    assert sorted((r.first, r.last) for r in projection.pointer_warnings(marks).collect()) == [("r4", "nobody"), ("r4", "r2")]


def test_records_and_quads_of_an_article(docs):
    nodes, edges = (materialize(x.where("doc = 'f1'"), "test", 1) for x in (projection.nodes(docs), projection.edges(docs)))
    articles = materialize(rdf_records.article_uri(records.articles(nodes, edges)), "test", 1)
    own = articles.where("source_type = 'pmc_oa'").first()
    assert (own.pages, own.author, own.editor, own.cites) == ("12--34", ["pmc:77:contributor:1", "pmc:77:contributor:2"], ["pmc:77:contributor:3"], [f"pmc:77:reference:r{i}" for i in (1, 2, 3)])
    assert (own.uri, own.part, own.retracts) == ("http://dx.doi.org/10.1/a%20b", ":doi/10.1/a%20b", ["pmc:77:retracted:1", "pmc:77:retracted:2"])
    people = {r.id[-1]: (r.name, r.style, r.affiliated) for r in records.people(nodes, edges).collect()}
    assert people == {"1": ("Mao, Li", "eastern", "pmc:77:affiliation:a2"), "3": ("Ed, It", "western", None)}
    places = materialize(rdf_records.organisation_uri(records.organisations(nodes)), "test", 1)
    assert places.count() == 4 and places.where("name = 'House'").first().address == "Town"
    journals = materialize(rdf_records.journal_uri(records.journals(nodes, edges).where("id = 'pmc:77:journal'")), "test", 1)
    assert journals.first().uri == "urn:issn:1111-2222"
    uris = materialize(rdf_records.uris(articles, journals, places), "test", 1)
    mine = articles.where("source_type = 'pmc_oa'")
    for refs in ("cites", "retracts"):
        mine = materialize(records.dereferenced(mine, "id", refs, uris), "test", 1)
    cited = mine.first().cites
    assert cited[2] == "id/expression:pmid/9" and cited[1] == "http://dx.doi.org/10.1234/xy" and mine.first().retracts[0] == "http://dx.doi.org/10.9/z"
    unknown = records.dereferenced(mine.withColumn("cites", F.array(F.lit("nobody"))), "id", "cites", uris).first()
    assert unknown.cites == ["nobody"]

    def triples(df):
        return {(r.s.rsplit("/", 1)[-1][:-1], r.p.rsplit("/", 1)[-1].rsplit("#", 1)[-1][:-1], r.o) for r in df.collect()}

    lists = triples(rdf_records.citation_quads(mine))
    assert ("1", "itemContent", f"<http://example.org/{cited[0]}>" if not cited[0].startswith("http") else f"<{cited[0]}>") in lists
    assert len([x for x in lists if x[1] == "nextItem"]) == 2 and len([x for x in lists if x[1] == "cites"]) == 3 and len([x for x in lists if x[1] == "retracts"]) == 2
    full = mine.withColumns({"journal_uri": F.lit("urn:issn:1111-2222"), "journal_part": F.lit("issn/1111-2222")})
    quads = [(r.s, r.p, r.o) for r in rdf_records.article_quads(full).collect()]
    volume, issue = "<http://example.org/id/journal/issn/1111-2222/5-b>", "<http://example.org/id/journal/issn/1111-2222/5-b/6>"
    part = "<http://purl.org/vocab/frbr/core#part>"
    assert {("<urn:issn:1111-2222>", part, volume), (volume, part, issue), (issue, part, "<http://dx.doi.org/10.1/a%20b>")} <= set(quads)
    assert any(o.startswith('"2004-03-01"^^') for _, _, o in quads) and ("<http://dx.doi.org/10.1/a%20b>", "<http://purl.org/dc/terms/title>", '"A great title"') in quads
    bare = rdf_records.article_quads(full.withColumns({"journal_uri": F.lit(None).cast("string"), "journal_part": F.lit(None).cast("string")}))
    assert bare.where(F.contains("s", F.lit("journal"))).count() == 0
    who = records.people(nodes, edges).where("style = 'eastern'").select("name", "surname", "given", "style", F.lit("author").alias("role"), F.lit(1).alias("position"), F.lit("x").alias("uri"), F.lit(":doi/x").alias("part"), F.lit(None).cast("string").alias("affiliation"))
    made = triples(rdf_records.person_quads(who))
    assert ("1", "name", '"Mao Li"') in made and ("x", "creator", "<http://example.org/graph/person:doi/x/author/1>") in made and ("role", "withRole", "<http://purl.org/spar/pro/author>") in made
    assert any(p == "sortLabel" for _, p, _ in made)
    assert rdf_records.journal_quads(journals).count() == 6 and rdf_records.organisation_quads(places).count() > 4


def test_csv_rows_and_tables(spark, docs, tmp_path):
    nodes, edges = projection.nodes(docs), projection.edges(docs)
    articles = records.articles(nodes, edges)
    assert {(r.target, r["count"]) for r in records.citation_rows(articles).collect()} == {(f"pmc:77:reference:r{i}", 1) for i in (1, 2, 3)}
    sinks.write_csv(records.article_rows(articles), f"{tmp_path}/a")
    back = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/a")
    assert back.where("id = 'pmc:77'").first().title == "A great title" and back.count() == articles.count()
    name = "ensured_test"
    assert sinks.ensured(spark, name, "a int, b string", rebuild=True).count() == 0
    with pytest.raises(ValueError):
        sinks.ensured(spark, name, "a string")
    spark.sql(f"DROP TABLE {name}")
    assert [tuple(r) for r in sinks.once(spark.createDataFrame([(1, "b"), (1, "a")], "k int, v string"), "k", "v").collect()] == [(1, "a")]


def test_docsums_complete_pages(spark):
    text = '<DocSum><Id>5</Id><Item Name="Title">T</Item><Item Name="Pages">1234-8</Item><Item Name="PubDate">2004-3</Item><Item Name="AuthorList"><Item Name="Author">A B</Item></Item><Item Name="ArticleIds"><Item Name="pmc">PMC9</Item><Item Name="doi">10.1/x</Item></Item><Item Name="ISSN">1-2</Item></DocSum>'
    rows = xml.docsums(spark.createDataFrame([(text,), ("<no",), ("<DocSum><Id>6</Id></DocSum>",)], "content string")).orderBy("pmid").collect()
    assert (rows[0].pmid, rows[0].first_page, rows[0].last_page, rows[0].year, rows[0].month, rows[0].day, rows[0].pmc, rows[0].doi, rows[0].author, rows[0].journal.issn) == ("5", "1234", "1238", "2004", "3", None, "9", "10.1/x", ["A B"], "1-2")
    assert (rows[1].pmid, rows[1].journal, rows[1].author, rows[1].first_page) == ("6", None, [], None) and len(rows) == 2


def test_registries(spark, tmp_path):
    with pytest.raises(KeyError, match="docsum"):
        registry.READERS["nothing"]
    (tmp_path / "a.nxml").write_text(ARTICLE)
    assert registry.read(spark, "articles", str(tmp_path)).first().title == "A great title"
    parts = registry.Components()
    parts.register("x", F.lit("a"), "J1")
    with pytest.raises(ValueError):
        parts.dispatch(spark.createDataFrame([("J1",)], "j string"), "j", ["x"])
    parts.register("x", F.lit("b"), weight=0.5, name="all")
    got = parts.dispatch(spark.createDataFrame([("J1",), ("J2",), (None,)], "j string"), "j", ["x"]).collect()
    assert [(r.j, r.x, r.x_by) for r in got] == [("J1", "a", "J1"), ("J2", "b", "all"), (None, "b", "all")]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "i int, k string"), spark.createDataFrame([(1, "x"), (3, "y")], "j int, k string")
    both = [lambda p, q: p.join(q, "k").select("i", "j"), lambda p, q: p.join(q, p.i == q.j).select("i", "j")]
    assert sorted(map(tuple, registry.candidates(both, a, b).collect())) == [(1, 1), (2, 3)]
    assert registry.after_search([1, 2], lambda r: r + [3], len) == 3


def test_enrichment_filters_and_addresses(spark):
    df = spark.createDataFrame([("h1", "2004", "Mar", "7"), ("h2", None, None, None)], "header_id string, year string, month string, day string").withColumns({"datestamp": F.lit("d"), "set_spec": F.lit("s"), "deleted": F.lit(False)})
    known = spark.createDataFrame([("oaipmh:h1", "k1")], "canonical string, id string")
    got = {r.header_id: r for r in enrich.harvested(df, known, "http://b/", "me", "c").collect()}
    assert (got["h1"]._id, got["h1"].url, got["h1"].date, got["h1"].is_new) == ("k1", "http://b/k1", "07/03/2004", False)
    assert got["h2"].is_new and got["h2"].date is None and got["h2"].identifier[0].canonical == "oaipmh:h2" and got["h2"]._collection == ["me_____c"]
    assert enrich.one_record(df, "header_id", "none").count() == 0 and enrich.not_seen(df, df.where("header_id = 'h1'"), "header_id").first().header_id == "h2"
    assert enrich.of_journals(df, "year", ["2004"]).count() == 1
    mails, names = spark.createDataFrame([(1, "annlee@x.org"), (2, "zz@x.org")], "p int, m string"), spark.createDataFrame([(1, "Ann Lee"), (1, "Xavier Quu"), (2, "A B"), (2, "B A")], "p int, n string")
    assert [r["name"] for r in graph.match_mails(mails, names, "p", "m", "n").collect()] == ["Ann Lee"]


def test_candidates_by_title_words(spark):
    titles = spark.createDataFrame([(1, "dark matter halos")], "k int, t string")
    docs = spark.createDataFrame([(i, "dark matter") for i in range(10)] + [(50, "dark matter halos"), (60, "dark"), (70, "none")], "d int, x string")
    got = [(r.d, r.n_words, r.rank) for r in match.search_candidates(titles, docs, "k", "t", "d", "x", most=4).orderBy("rank").collect()]
    assert got == [(50, 3, 1), (0, 2, 2), (1, 2, 3), (2, 2, 4)]
    many = match.search_candidates(titles.withColumn("t", F.lit("dark matter")), docs, "k", "t", "d", "x", most=4)
    assert many.where("n_words = 2").count() == 11  # eleven are as good as the best: four are doubled to sixteen


def test_organisations_of_the_same_name_and_address_are_one(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("a", None), (None, "a")], "n string, a string")
    keys = [r.k for r in df.select(records.organisation_key(F.col("n"), F.col("a")).alias("k")).collect()]
    assert keys[0] == keys[1] and len(set(keys)) == 3
