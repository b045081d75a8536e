"""Articles read and projected in one pass: the same as by all fields, nodes and edges, without shuffles of texts."""

import pytest
from pyspark.sql import functions as F
from test_records import ARTICLE, NESTED

import __spark_entry__ as entry
from citeweave.operators import rdf, rdf_records, records
from citeweave.session import materialize
from citeweave.sources import projection, xml

SF = "/root/testdata/sf0.001"
DOCS = [
    ("f1", ARTICLE), ("f2", "<broken"), ("f3", "<article><front/></article>"), ("n", NESTED), ("none", None),
    ("g", '<article><front/><back><ref-list><ref id="a"><element-citation><source>S</source><person-group person-group-type="author"><name><surname>X</surname></name><name><given-names>Y</given-names></name></person-group></element-citation></ref><ref/></ref-list></back></article>'),
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(DOCS, "path string, content string").coalesce(1)


@pytest.fixture(scope="module")
def docs(rows):
    return materialize(xml.articles(rows), "test", 1)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def once(df):
    """Whether texts are parsed once, and not shuffled before."""
    plan = plan_of(df)
    return plan.count("MapInArrow") == 1 and "Repartition" not in plan.split("MapInArrow")[1].split("Project")[0]


def test_only_the_fields_asked_for_are_read(rows, docs):
    some = xml.articles(rows, only=("identifier", "citation.id", "citation.people", "year"))
    assert some.columns == ["path", "year", "identifier", "citation", "error"]
    assert [f.name for f in some.schema["citation"].dataType.elementType] == ["id", "people"]
    cited = F.transform("citation", lambda c: F.struct(c["id"].alias("id"), c["people"].alias("people")))
    want = docs.select("path", "year", "identifier", cited.alias("citation"), "error")
    assert sorted(map(str, some.collect())) == sorted(map(str, want.collect()))
    with pytest.raises(ValueError, match="nothing"):
        xml.articles(rows, only=("nothing", "citation.id"))


def test_namespaces_and_encodings():
    for text in ('<a:article xmlns:a="u"><a:front/></a:article>', '<article xmlns = "u"><front/></article>', '<?xml version="1.0" encoding="ISO-8859-1"?><article xmlns:x="u"><front/><x:é/></article>'):
        tree = xml._parse(text)
        assert tree.tag == "article" and tree[0].tag == "front" and [e.tag for e in tree][1:] in ([], ["é"])


def test_pointers_and_warnings_in_one_pass(spark, docs):
    marks = projection.marks(docs)
    got = [(r.id, r.section, r.paragraph, r.rid) for r in projection.pointed(docs).where("NOT odd").collect()]
    want = [(r.id, r.section, r.paragraph, r.rid) for r in projection.denotes(marks).collect()]
    assert sorted(got) == sorted(want) and len(got) > 5
    odd = projection.pointed(docs).where("odd")
    assert sorted(r.id for r in odd.collect()) == sorted(r.id for r in projection.pointer_warnings(marks).collect())
    assert odd.where("rid IS NULL").count() == odd.count() == 2
    assert once(entry.queries()["text_pointers"](spark, SF))


def rows_of(df, *cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize(("kind", "query"), [("journal", "journal_records"), ("person", "person_records"), ("article", "article_records")])
def test_nodes_with_their_edges_are_what_is_joined(spark, docs, kind, query):
    nodes, edges = (materialize(x, "test", 1) for x in (projection.nodes(docs), projection.edges(docs)))
    want = records.outgoing(nodes.where(F.col("type") == kind), edges)
    want = want.where("data['provenance'] = 'pmc_oa'") if kind == "article" else want
    cols = ["doc", "id", "type", F.sort_array(F.map_entries("data")), "out"]
    got = projection.linked(docs, kind)
    assert rows_of(got, *cols) == rows_of(want, *cols) and len(got.take(4)) > 2
    plan = plan_of(entry.queries()[query](spark, SF))
    assert once(entry.queries()[query](spark, SF)) and plan.count("Join") == 1  # of orders and lines


def test_edges_of_cited_works_are_what_is_joined(spark, docs):
    nodes, edges = (materialize(x, "test", 1) for x in (projection.nodes(docs), projection.edges(docs)))
    named = nodes.where("type IN ('journal', 'person')").select("doc", F.col("id").alias("target"), F.coalesce(F.try_element_at("data", F.lit("nlm_ta")), F.try_element_at("data", F.lit("surname"))).alias("name"))
    of = {c: F.try_element_at("data", F.lit(k)) for c, k in {"role": "contrib-type", "count": "count", "paragraphs": "paragraphs"}.items()}
    want = edges.where("type = 'cites' OR (type IN ('journal', 'contributor') AND contains(source, ':reference:'))").join(named, ["doc", "target"], "left")
    cols = ["doc", "type", "source", "target", "name"]
    assert rows_of(projection.cited_edges(docs), *cols, "role", F.col("count").cast("string"), "paragraphs") == rows_of(want, *cols, *of.values())
    assert once(entry.queries()["cited_works"](spark, SF))


def test_works_named_with_their_articles_have_the_uris_of_a_join(spark, rows):
    """Also where two references have one id, or none."""
    cited = "".join(f'<ref id="a"><element-citation publication-type="journal"><pub-id pub-id-type="pmid">{n}</pub-id></element-citation></ref>' for n in (7, 5))
    odd = spark.createDataFrame([("t", f"<article><front/><back><ref-list>{cited}<ref>See http://x/y</ref><ref>doi 10.1234/q</ref></ref-list></back></article>")], "path string, content string")
    docs = materialize(xml.articles(rows.unionByName(odd)), "test", 1)
    nodes, edges = (materialize(x, "test", 1) for x in (projection.nodes(docs), projection.edges(docs)))
    found = materialize(rdf_records.article_uri(records.articles(nodes, edges)), "test", 1)
    want, got = found.where("source_type = 'pmc_oa'"), rdf_records.article_uri(records.articles(projection.referred(docs)))
    uris = materialize(rdf_records.uris(found), "test", 1)
    for works, refs in (("cited", "cites"), ("retracted", "retracts")):
        want = materialize(records.dereferenced(want, "id", refs, uris), "test", 1)
        got = rdf_records.referred_uris(got, works, refs)
    assert rows_of(got, "id", "uri", "part", "title", "cites", "retracts") == rows_of(want, "id", "uri", "part", "title", "cites", "retracts")
    assert got.where("doc = 't'").first().cites[:2] == ["id/expression:pmid/5"] * 2
    assert once(entry.queries()["rdf_citation_counts"](spark, SF))


def test_iris_and_literals_are_made_apart(spark):
    """What is illegal in an IRI is found wherever it stands; a value's making isn't written out in the row's code."""
    texts = ["a", "http://x/y", "a b", "a\n", "\\", "é{", "urn:x", "", None, 'q"', "x\u007f", "𝒳|", "𝒳"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(rdf.iri(F.col("t")), rdf.literal(F.col("t"), "d"), rdf.literal(F.lit(3))).collect()]
    bad = set('<>"{}|^`\\') | {chr(i) for i in range(33)}
    for t, (iri, text, three) in zip(texts, got, strict=True):
        full = None if t is None else t if t.startswith(("http:", "urn:")) else rdf.BASE + t
        assert iri == (None if full is None or set(full) & bad else f"<{full}>") and three == '"3"'
        escaped = None if t is None else t.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        assert text == (None if t is None else f'"{escaped}"^^<d>')
    wide = df.select(*[rdf.iri(F.concat("t", F.lit(f"{i}"))).alias(f"c{i}") for i in range(30)])
    code = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(wide._jdf.queryExecution().executedPlan())
    assert all("RLike" not in code.apply(i)._2() and "matcher" not in code.apply(i)._2() for i in range(code.size()))
