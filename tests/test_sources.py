import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from citeweave.search.request import Clause, Facet, SearchRequest, author_view, paper_view, search, search_view, suggest, token_index
from citeweave.sources import archives, sinks, xml
from citeweave.streaming import ingest

ARTICLE = """<?xml version="1.0"?><!DOCTYPE article PUBLIC "x" "y.dtd">
<article xmlns:xlink="http://www.w3.org/1999/xlink"><front><journal-meta><journal-title>J. Tests</journal-title><publisher><publisher-name>P</publisher-name></publisher></journal-meta>
<article-meta><article-id pub-id-type="pmid">1</article-id><article-id pub-id-type="doi">10.1234/a</article-id><title-group><article-title>On <italic>mixed</italic> content</article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Lee</surname><given-names>Ann</given-names></name><xref ref-type="aff" rid="a1 a2"/></contrib></contrib-group><aff id="a1">Here</aff><aff id="a2">There</aff>
<pub-date pub-type="epub"><year>2001</year></pub-date><pub-date pub-type="ppub"><year>2000</year><month>3</month></pub-date><volume>7</volume><kwd-group><kwd>k1</kwd></kwd-group></article-meta></front>
<body><sec><p>As shown <xref ref-type="bibr" rid="r1"/>–<xref ref-type="bibr" rid="r3"/>.</p></sec></body>
<back><ref-list>REFS</ref-list></back></article>""".replace(
    "REFS", "".join(f'<ref id="r{i}"><mixed-citation publication-type="journal"><name><surname>S{i}</surname></name><article-title>T{i}</article-title><year>199{i}</year><pub-id pub-id-type="pmid">{i}</pub-id></mixed-citation></ref>' for i in range(1, 4))
)


def tar_of(files):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as tar:
        for name, data in files.items():
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.tar").write_bytes(tar_of({"x/1.nxml": ARTICLE.encode(), "x/2.nxml": b"<broken", "x/3.txt": b"no"}))
    (tmp_path / "t.gz").write_bytes(gzip.compress(tar_of({"m.tex": b"text", "m.bbl": b"refs", "f.png": b"\x89PNG"})))
    (tmp_path / "p.gz").write_bytes(gzip.compress(b"%PDF-1.4 ..."))
    (tmp_path / "s.gz").write_bytes(gzip.compress(b"\\documentclass{x}"))
    (tmp_path / "c.gz").write_bytes(gzip.compress(b"cut off")[:-6])
    return tmp_path


def test_articles_from_an_archive(spark, folder):
    files = archives.tar_members(archives.binary_files(spark, str(folder), "*.tar"), (".nxml",))
    got = {r.member: r for r in xml.articles(files, keep="member").collect()}
    a, bad = got["x/1.nxml"], got["x/2.nxml"]
    assert bad.error and bad.title is None
    assert (a.title, a.journal, a.year, a.month, a.volume, a.keyword) == ("On mixed content", "J. Tests", "2000", "3", "7", ["k1"])
    assert [i.canonical for i in a.identifier] == ["pmid:1", "doi:10.1234/a"]
    assert (a.author[0].lastname, a.author[0].affiliation) == ("Lee", ["Here", "There"])
    assert [(c.cite_order, c.title, c.year, c.identifier[0].canonical) for c in a.citation] == [(i, f"T{i}", f"199{i}", f"pmid:{i}") for i in (1, 2, 3)]
    assert a.pointer[0].rids == ["r1", "r2", "r3"]


def test_tex_of_gzips(spark, folder):
    got = {r.path.rpartition("/")[2]: r.text for r in archives.tex_sources(archives.binary_files(spark, str(folder), "*.gz")).collect()}
    assert "text" in got["t.gz"] and "refs" in got["t.gz"] and "PNG" not in got["t.gz"]
    assert (got["p.gz"], got["s.gz"], got["c.gz"]) == ("", "\\documentclass{x}", "")
    assert archives.binary_files(spark, str(folder), "*.gz", 10).count() == 0


def test_lines_and_tables(spark, tmp_path):
    (tmp_path / "refs").write_text("s|ref one|t\ns2|ref two|\nbad|line\n")
    assert [tuple(r) for r in archives.pipe_lines(spark, str(tmp_path / "refs"), ["s", "r", "t"]).collect()] == [("s", "ref one", "t"), ("s2", "ref two", "")]
    (tmp_path / "mails").write_text("p1|a@b.c| |d@e.f\np2\n")
    assert [tuple(r) for r in archives.email_lines(spark, str(tmp_path / "mails")).collect()] == [("p1", "a@b.c"), ("p1", "d@e.f")]
    a = spark.createDataFrame([("x", 1, "m"), ("y", 1, "m"), ("z", 2, "n")], "path string, size long, md5 string")
    b = spark.createDataFrame([("x", 1, "m"), ("z", 3, "n"), ("w", 1, "q")], "path string, size long, md5 string")
    assert sorted(map(tuple, archives.changed_files(a, b).collect())) == [("w", "delete"), ("y", "copy"), ("z", "replace")]


def test_graphml_round_trip(spark):
    nodes = spark.createDataFrame([("a", "A & B", 1), ("b", None, 2)], "id string, label string, n int")
    edges = spark.createDataFrame([("a", "b", 0.5)], "src string, dst string, w double")
    text = "\n".join(r.value for r in sinks.graphml(nodes, edges, "id", "src", "dst", directed=False).orderBy("part").collect())
    n, e = sinks.read_graphml(spark.createDataFrame([(text,)], "content string"))
    assert {r.id: dict(r.data) for r in n.collect()} == {"a": {"label": "A & B", "n": "1"}, "b": {"n": "2"}}
    assert sorted((r.src, r.dst, r.data["w"]) for r in e.collect()) == [("a", "b", "0.5"), ("b", "a", "0.5")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a|b", None), ("c", "d")], "x string, y string")
    assert [r.value for r in sinks.pipe_text(df, ["x", "y"]).collect()] == ["ab|", "c|d"]
    sinks.write_json_batches(df.coalesce(1), str(tmp_path / "j"), 1)
    assert len(list((tmp_path / "j").glob("*.json"))) == 2


def test_node_and_edge_xml(spark):
    text = '<article-data><node id="n1" type="article"><data key="title">T</data></node><edge type="author" source="n1" target="n2"><data key="pos">1</data></edge></article-data>'
    n, e = xml.nodes_and_edges(spark.createDataFrame([("d", text)], "path string, content string"))
    assert [(r.id, r.type, dict(r.data)) for r in n.collect()] == [("n1", "article", {"title": "T"})]
    assert [(r.source, r.target, dict(r.data)) for r in e.collect()] == [("n1", "n2", {"pos": "1"})]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, "Dark matter halos", ["x", "y"], 10, [("s", 1), ("t", 9)]), (2, "Bright matter", ["x"], 20, [("s", 9)]), (3, "Hale stars", None, 30, [])]
    return spark.createDataFrame(rows, "id int, title string, tags array<string>, n int, parts array<struct<k:string,v:int>>")


@pytest.mark.parametrize(
    ("request_", "want"),
    [
        (SearchRequest(must=[Clause("match_all")]), [1, 2, 3]),
        (SearchRequest(must=[Clause("term", "tags", "x")]), [1, 2]),
        (SearchRequest(must_not=[Clause("term", "tags", "y")]), [2, 3]),
        (SearchRequest(should=[Clause("term", "id", 1), Clause("term", "id", 3)]), [1, 3]),
        (SearchRequest(must=[Clause("any_of", "tags", ["y"])]), [1]),
        (SearchRequest(must=[Clause("range", "n", lo=10, hi=20)]), [1, 2]),
        (SearchRequest(must=[Clause("query_string", "title", "matter AND dark")]), [1]),
        (SearchRequest(must=[Clause("query_string", "title", "hal* OR bright")]), [1, 2, 3]),
        (SearchRequest(must=[Clause("query_string", "title", "sters~1")]), [3]),
        (SearchRequest(must=[Clause("query_string", "title", '"matter halos"')]), [1]),
        (SearchRequest(must=[Clause("prefix", "title", "d")]), [1]),
        (SearchRequest(must=[Clause("nested", "parts", clauses=[Clause("term", "k", "s"), Clause("range", "v", lo=5)])]), [2]),
        (SearchRequest(must=[Clause("match_all")], always=[Clause("term", "id", 2)]), [2]),
    ],
)
def test_requests(corpus, request_, want):
    request_ = SearchRequest.from_json(request_.to_json())
    request_.sort = [("id", "asc")]
    assert [r.id for r in search(corpus, request_).hits.collect()] == want


def test_facets_pages_and_suggestions(corpus):
    r = search(corpus, SearchRequest(facets=[Facet("tags", "tags"), Facet("some", "tags", clauses=[Clause("term", "id", 2)])], sort=[("n", "desc")], offset=1, size=1, fields=["id"]))
    assert r.total.first().total == 3 and [tuple(x) for x in r.hits.collect()] == [(2,)]
    assert [tuple(x) for x in r.facets["tags"].collect()] == [("x", 2), ("y", 1)] and [tuple(x) for x in r.facets["some"].collect()] == [("x", 1)]
    assert [x.term for x in suggest(corpus, "title", "h").collect()] == ["Hale stars"]
    assert [x.term for x in suggest(corpus, "title", "dark ha").collect()] == ["Dark matter halos"]


def test_views(spark, corpus):
    cites = spark.createDataFrame([(1, 2), (3, 2), (1, 3)], "src int, dst int")
    unknown = spark.createDataFrame([(1, "lost")], "src int, ref string")
    view = paper_view(1, corpus, cites, unknown)
    assert [r.id for r in view["references"].collect()] == [2, 3] and view["unknown"].count() == 1 and view["cited_by"].count() == 0
    who = spark.createDataFrame([("Ann", 3), ("Ann", 2)], "name string, paper int")
    assert [(r.id, r.citations) for r in author_view("Ann", who, corpus, cites).collect()] == [(2, 2), (3, 1)]
    assert [r.id for r in search_view("matter BRIGHT", token_index(corpus, "id", "title"), corpus, cites).collect()] == [2]


def test_stream_resumes_and_equals_the_batch(spark, tmp_path):
    land, store, state = (str(tmp_path / n) for n in ("land", "store", "state"))
    first = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    first.write.parquet(land)
    sink = ingest.upsert_batches(spark, store, "k", "o")
    ingest.drain(ingest.file_stream(spark, land, first.schema), state, sink)
    spark.createDataFrame([(2, "c", 2), (3, "d", 1)], first.schema).write.mode("append").parquet(land)
    ingest.drain(ingest.file_stream(spark, land, first.schema), state, sink)
    assert sorted(map(tuple, ingest.current(spark, store, "k", "o").collect())) == [(1, "a", 1), (2, "c", 2), (3, "d", 1)]


def test_harvest_windows(spark):
    assert [tuple(map(str, r)) for r in ingest.day_windows(spark, "2020-01-30", "2020-02-02", 3).collect()] == [("2020-01-30", "2020-02-01"), ("2020-02-02", "2020-02-02")]
    state = spark.createDataFrame([], "key string, uri string, from_date date, to_date date, number_of_records long")
    state = ingest.record_harvest(ingest.record_harvest(state, "u", "2020-01-01", "2020-01-05", 3), "u", "2020-01-06", "2020-01-09", 1)
    assert state.count() == 1 and str(ingest.next_window(state, "u", "2000-01-01").first().start) == "2020-01-10"
    assert str(ingest.next_window(state, "v", "2000-01-01").first().start) == "2000-01-01"


def test_datasets(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"recordList": [{"id": "a", "type": "Article"}, {"id": "p", "type": "Person"}]}))
    data = archives.json_records(spark, str(tmp_path))
    assert [r.id for r in archives.dataset_records(data, "Article").collect()] == ["a"]
    assert data.select(F.size("recordList")).first()[0] == 2
