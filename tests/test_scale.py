"""What keeps pairs and records of large tables small: results by brute force, and plans without shuffles of pairs."""

import random

from pyspark.sql import functions as F

from citeweave.functions import similarity
from citeweave.operators import deref, graph, match, rdf_records, records, resolve
from citeweave.session import tasks


def test_pairs_of_frequent_keys_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(resolve, "PART", 7)
    r = random.Random(4)
    docs = [(i, r.choice(["", "t1", "t2", None]), [r.choice("abc"), r.choice("abcd")]) for i in range(60)]
    citing = spark.createDataFrame([(i, 1, t, k) for i, t, k in docs], "source int, cite_order int, title string, ids array<string>")
    found = resolve.match_cites(citing, spark.createDataFrame(docs, "target int, title string, ids array<string>"))
    keys = {i: ([f"title:{t}"] if t else []) + k for i, t, k in docs}
    want = {(a, 1, b, len(shared), shared[-1]) for a in keys for b in keys if a != b and (shared := [k for k in keys[a] if k in keys[b]])}
    got = [tuple(x) for x in found.collect()]
    assert len(got) == len(want) and set(got) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in plan


def test_distances_of_packs_are_those_of_pairs(spark, monkeypatch):
    """All fields, with copies, nulls and names whose likeness has a direction; and as many tasks as asked for, however small the records."""
    r = random.Random(6)
    fields = {"title": "t", "author": "p", "volume": "v", "year": "y", "uri": "u"}
    rows = [(i, r.choice("bc"), r.choice(["one", "two", None, "onto"]), r.choice(["Smith J", "J Smith", "Smith John, Lee A", "Lee AB", ""]), r.choice(["1", "12", ""]), r.choice(["1990", "1700", "1993"]), r.choice(["http://a", "http://b", None])) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, k string, t string, p string, v string, y string, u string")
    x, y = df.alias("x"), df.alias("y")
    d = similarity.distance(*[{k: F.col(f"{s}.{c}") for k, c in fields.items()} for s in "xy"])
    want = x.join(y, (F.col("x.k") == F.col("y.k")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id"), F.col("y.id"), d)
    monkeypatch.setattr(match, "PART", 9)
    monkeypatch.setattr(match, "PACK", 3)
    found = match.distances(df, ["k"], "id", fields)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert found.rdd.getNumPartitions() >= tasks(spark)


def test_copies_are_clustered_as_one_and_small_groups_without_rounds(spark, monkeypatch):
    df = spark.createDataFrame([(i, "b" if i < 30 else None, f"name {i % 5}" if i % 7 else None) for i in range(40)], "id long, k string, t string")
    least = {x.id: x.least for x in match.representatives(df, ["k"], "id", {"title": "t"}).collect()}
    assert least == {i: min(j for j in range(30) if j % 7 and j % 5 == i % 5) if i < 30 and i % 7 else i for i in range(40)}
    monkeypatch.setattr(graph, "connected_components", lambda *_: 1 / 0)
    pairs = spark.createDataFrame([("g", 1, 2, 0.5), ("g", 2, 3, 0.3), ("g", 3, 4, 0.3), ("h", 1, 2, 1.5)], "group string, a long, b long, distance double")
    members = spark.createDataFrame([(g, i) for g in "gh" for i in range(1, 5)], "group string, id long")
    got = {(x.group, x.id): x.cluster for x in graph.recluster(pairs, members).collect()}
    assert got == {("g", 1): 1, ("g", 2): 1, ("g", 3): 1, ("g", 4): 4} | {("h", i): i for i in range(1, 5)}


def test_a_frequent_author_is_not_paired_with_all_references(spark, monkeypatch):
    r = random.Random(3)
    vocabulary = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]
    works = [(f"{i}", " ".join(r.choices(vocabulary, k=3)), r.choice([1995, 1996])) for i in range(150)]
    refs = [(i, f"Xx, {' '.join(r.choices(vocabulary, k=2) + t.split()[i % 2 :])} ({y})") for i, (_, t, y) in enumerate(works)]
    seen, plain = [], match.year_band_join
    monkeypatch.setattr(match, "year_band_join", lambda *a: (seen.append(plain(*a)), seen[-1])[1])
    args = spark.createDataFrame(refs, "ref_id int, ref_string string"), spark.createDataFrame(works, "work_id string, title string, year int"), spark.createDataFrame([(w, "Xx") for w, _, _ in works], "work_id string, author string")
    got = {x.ref_id: (x.target, x.how) for x in match.match_references(*args, coverage=0.7).collect()}
    want = {}
    for i, text in refs:
        held, year = set(text.replace(",", "").split()), int(text[-5:-1])
        fit = [w for w, t, y in works if year - 2 <= y <= year and len(set(t.split()) & held) / 3 > 0.7]
        want |= {i: (min(fit), "title")} if fit else {}
    assert got == want and len(got) > 50
    assert seen[0].count() < 150 * 150 / 4


def test_journals_shuffle_no_citations(spark):
    rows = spark.createDataFrame([("d", "j", "journal", {"title": "J"})], "doc string, id string, type string, data map<string,string>")
    none = F.create_map().cast("map<string,string>")
    edges = [spark.range(1).select(F.lit("d").alias("doc"), F.lit(k).alias("type"), F.lit("j").alias("source"), F.lit("p").alias("target"), none.alias("data")) for k in ("publisher", "cites")]
    found = records.journals(rows, edges[0].unionByName(edges[1]))
    assert [(x.name, x.publisher) for x in found.collect()] == [("J", "p")]
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_fields_are_merged_as_columns_as_leaves_are(spark):
    """Groups of one record and of many, nulls, ties, lists of the same length; against votes over leaves."""
    r = random.Random(9)
    rows = [(f"{i}", f"g{r.choice([i, i % 7])}", r.choice(["pmc_oa", "pubmed_api", "pmc_oa_reference"]), r.choice(["T", "S", None]), r.choice([1, 2, None]), [f"@{r.randint(0, 9)}" for _ in range(r.randint(0, 3))]) for i in range(80)]
    df = spark.createDataFrame(rows, "id string, group string, source string, title string, n int, refs array<string>")
    df = df.withColumn("cites", F.transform("refs", lambda x: F.struct(x.alias("ref")))).drop("refs")
    uris = spark.createDataFrame([(str(i), f"u{i}") for i in range(10)], "id string, uri string")
    followed = deref.followed(deref.shredded(df, "id", ["title", "n", "cites"]), lambda _: 1 / 0, uris)  # all have URIs: no record is met
    merged = deref.voted(deref.valued(followed), df.select("id", "group", "source"), ("cites",))
    want = {tuple(map(str, x)) for x in deref.widened(merged, ["title", "n"], ("cites",)).collect()}
    own = deref.elected(deref.saying(df, ["title", "n", "cites"]), ["title", "n"])
    lists = deref.longest(deref.valued(deref.followed(deref.shredded(df, "id", ["cites"]), lambda _: 1 / 0, uris)), df, ("cites",))
    got = [tuple(map(str, x)) for x in own.join(lists, "group", "left").collect()]
    assert len(got) == len(want) > 10 and set(got) == want


def test_quads_of_several_subjects_are_made_in_one_pass(spark):
    df = spark.createDataFrame([("u", ":pmid/1", "T", ["a", "b"], ["z"]), ("v", ":pmid/2", None, None, ["y"])], "uri string, part string, title string, cites array<string>, retracts array<string>")
    found = rdf_records.citation_quads(df)
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
    # u: list 4, part 1, cites 2, items 2 with first and last, 2 * (type, content) and one next, retracts 1; v: retracts 1
    assert found.count() == 4 + 1 + 2 + 4 + 5 + 1 + 1


def test_identifiers_are_not_shuffled_to_be_made_distinct(spark, monkeypatch):
    """Repeated rows, nulls and identifiers of one record; what reaches the components is edges between different records only."""
    rows = [(1, "a", "x"), (1, "a", "x"), (2, "a", "x"), (3, "b", "x"), (4, "b", None), (5, "b", "y"), (5, "b", "y"), (2, "b", "z"), (6, "b", "z"), (7, None, "x")]
    df = spark.createDataFrame(rows, "r int, scheme string, v string")
    seen, plain = [], graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda e: (seen.append(e), plain(e))[1])
    assert {tuple(x) for x in graph.unify(df, "r", "scheme", "v").collect()} == {(1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 1), (7, 7)}
    assert {tuple(x) for x in seen[0].collect()} == {(2, 1), (6, 2)}
