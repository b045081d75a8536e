"""Small operators that had no test of their own."""

import gzip
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from citeweave.functions import audit
from citeweave.operators import match, stats
from citeweave.plans import registry
from citeweave.session import tasks
from citeweave.sources import archives, xml
from citeweave.streaming import ingest


def test_topic_tables_skip_each_files_heading(spark, tmp_path):
    heading = "a\nb,c\n\"d\ne\"\nf\n"  # four rows, one over two lines
    (tmp_path / "x.csv").write_text(heading + 'stars,"red dwarf, nova"\nempty,\n')
    (tmp_path / "y.csv").write_text(heading + '"multi\nline",one\n')
    got = {r.topic: r.pattern for r in archives.topic_config(spark, str(tmp_path)).collect()}
    assert got == {"stars": "(?i)red dwarf|nova", "multi\nline": "(?i)one"}


def test_magic_bytes(spark):
    df = spark.createDataFrame([(gzip.compress(b"x"),), (b"\x1f\x8c",), (b"",), (None,)], "c binary")
    assert [r[0] for r in df.select(archives.is_gzip(F.col("c"))).collect()] == [True, False, False, None]


def test_counters_fill_while_a_frame_runs(spark):
    df, seen = stats.observed(spark.range(10), "status", rows=F.count("*"), top=F.max("id"))
    assert df.count() == 10 and seen.get == {"rows": 10, "top": 9}


def test_author_counts_with_a_limit(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "author string").coalesce(1)
    assert {r.author: r.n for r in stats.author_counts(rows, "author").collect()} == {"a": 2, "b": 1}
    assert {r.author: r.n for r in stats.author_counts(rows, "author", 2).collect()} == {"a": 2}


def test_text_before_the_first_child():
    e = ET.fromstring("<a> one <b>two</b> three</a>")
    assert (xml.first_text(e), xml.full_text(e), xml.first_text(e.find("b")), xml.first_text(None)) == ("one", "one two three", "two", None)
    assert xml.first_text(ET.fromstring("<a><b/>x</a>")) is None


def test_done_files_go(spark, tmp_path):
    for i in range(3):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = ingest.file_stream(spark, f"{tmp_path}/in", spark.range(1).schema, files=1, clean="delete")
    ingest.drain(stream, f"{tmp_path}/state", path=f"{tmp_path}/out")
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 2]
    assert len(list((tmp_path / "in").glob("*.parquet"))) < 3


def test_patterns_of_journals_are_no_wildcards_but_stars(spark):
    parts = registry.Components()
    parts.register("kind", F.lit("any"), weight=0.1)
    parts.register("kind", F.lit("one"), "J_1", 2.0)
    parts.register("kind", F.lit("some"), "10% (*)", 1.0)
    df = spark.createDataFrame([("J_1",), ("Jx1",), ("10% (a)",), ("10x (a)",), (None,)], "j string")
    assert [r.kind for r in parts.dispatch(df, "j", ["kind"]).collect()] == ["one", "any", "some", "any", "any"]


def test_both_corrections_of_an_issue(spark):
    df = spark.createDataFrame([("Pt 4 Pt 1",), ("Pt 2",), ("4 Pt 1",), ("7",), (None,)], "issue string")
    got = [(r.issue, len(r.errors)) for r in audit.sanitize_issue(df).collect()]
    assert got == [("4", 2), ("2", 1), ("4", 1), ("7", 0), (None, 0)]


def test_articles_are_parsed_in_many_tasks(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("path"), F.lit("<article><front/></article>").alias("content")).coalesce(1)
    parsed = xml.articles(rows, partitions=tasks(spark)).select("path", F.spark_partition_id().alias("p"))
    assert parsed.select("p").distinct().count() > 1 and parsed.count() == 100


def test_best_candidates_are_those_of_all_pairs(spark):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    docs = [(i, " ".join([*[w for j, w in enumerate(words) if (i * 7 + j * 13) % (j + 2) < 2], "the", "of" if i % 2 else "in"])) for i in range(200)] + [(900, None), (901, "")]
    titles = [(k, f"The {words[k]} of {words[(k * 5) % 120]} in {words[(k * 11) % 7]}") for k in range(25)] + [(90, ""), (91, None), (92, "unheard"), (93, "the")]
    a, b = spark.createDataFrame(titles, "k int, t string"), spark.createDataFrame(docs, "d int, x string")
    scored = []
    got = {}
    for r in match.top_candidates(a, b, "k", "t", "d", "x", 5, scored).orderBy("k", "rank").collect():
        got.setdefault(r.k, []).append((-r.score, r.d))
    held = {d: set((x or "").split()) for d, x in docs}
    import math

    often = {w: sum(w in h for h in held.values()) for w in {*words, "the", "of", "in"}}
    weight = {w: math.floor(math.log(1 + len(docs) / n) * 1_000_000 + 0.5) for w, n in often.items() if n}
    pairs = 0
    for k, t in titles:
        own = set((t or "").lower().split())
        found = sorted((-sum(weight[w] for w in own & h), d) for d, h in held.items() if own & h)
        pairs += len(found)
        assert got.get(k, []) == found[:5], k
    assert sum(s.count() for s in scored) < pairs / 2
