import random
import re

import pytest
from pyspark.sql import functions as F

from citeweave.operators import graph, match, rdf, resolve, stats, vote, windows


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()))


def test_components_are_the_full_closure(spark):
    pairs = [("A", "x"), ("B", "y"), ("B", "z"), ("C", "x"), ("C", "y"), ("D", "z"), ("E", None), ("F", "w")]
    df = spark.createDataFrame([(r, "s", v) for r, v in pairs], "record string, scheme string, value string")
    assert rows(graph.unify(df, "record", "scheme", "value"), "record", "group") == [("A", "A"), ("B", "A"), ("C", "A"), ("D", "A"), ("E", "E"), ("F", "F")]


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(200)]
    df = spark.createDataFrame([*path, *star, (7, 7), (None, 3)], "src long, dst long")
    got = dict(rows(graph.connected_components(df), "node", "component"))
    assert set(got.values()) == {0, 1000} and len(got) == 61 + 200
    assert graph.connected_components(df.where("false")).count() == 0


def test_rank_of_a_cycle_stays(spark):
    nodes = spark.createDataFrame([(i,) for i in range(4)], "id long")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "src long, dst long")
    assert [round(r, 9) for _, r in rows(graph.cite_rank(nodes, edges), "id", "rank")] == [1.0, 1.0, 1.0, 0.15]


def test_traversal_ends_on_cycles_and_keeps_least_levels(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (0, 2), (2, 3)], "src long, dst long")
    seeds = spark.createDataFrame([(0,)], "id long")
    assert rows(graph.bfs(seeds, edges), "id", "level") == [(0, 0), (1, 1), (2, 1), (3, 2)]
    assert rows(graph.bfs(seeds, edges, 1), "id", "level") == [(0, 0), (1, 1), (2, 1)]


def test_closure_stops_at_split_types(spark):
    records = spark.createDataFrame([("a", "Article"), ("j", "Journal"), ("p", "Person"), ("q", "Person")], "id string, type string")
    refs = spark.createDataFrame([("a", "p"), ("p", "q"), ("q", "p"), ("a", "j")], "src string, dst string")
    assert rows(graph.closure(records, refs, ["Article", "Journal"]), "root", "id") == [("a", "a"), ("a", "p"), ("a", "q"), ("j", "j")]


def test_clusters_grow_along_shortest_paths(spark):
    members = spark.createDataFrame([("g", i) for i in range(5)], "group string, id long")
    pairs = spark.createDataFrame([("g", 0, 1, 0.4), ("g", 1, 2, 0.4), ("g", 2, 3, 0.4), ("g", 3, 4, 0.5)], "group string, a long, b long, distance double")
    assert rows(graph.recluster(pairs, members), "id", "cluster") == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3)]


def brute_clusters(members, pairs, threshold=0.9):
    """A member after another seeds, and takes what is left within the threshold by shortest paths (all pairs' distances relaxed)."""
    out = {}
    for g in {m[0] for m in members}:
        left = sorted(i for h, i in members if h == g)
        near = {}
        for h, a, b, d in pairs:
            if h == g and d <= threshold:
                near[a, b] = near[b, a] = d
        while left:
            dist = {left[0]: 0.0}
            for _ in left:
                for (a, b), d in near.items():
                    if a in dist and b in left and dist[a] + d <= threshold:
                        dist[b] = min(dist.get(b, 9.0), dist[a] + d)
            out |= {(g, i): left[0] for i in dist}
            left = [i for i in left if i not in dist]
    return out


@pytest.mark.parametrize("local", [graph.LOCAL_PAIRS, 0, 12])
def test_clusters_of_random_groups(spark, local):
    r = random.Random(local)
    members = [(f"g{g}", 100 * g + i) for g in range(4) for i in range(25)]
    pairs = [(f"g{g}", 100 * g + a, 100 * g + b, r.choice([0.3, 0.45, 0.6, 0.95])) for g in range(4) for a in range(25) for b in range(a + 1, 25) if r.random() < 0.05 * (g + 1)]
    got = graph.recluster(spark.createDataFrame(pairs, "group string, a long, b long, distance double"), spark.createDataFrame(members, "group string, id long"), 0.9, local)
    assert {(x.group, x.id): x.cluster for x in got.collect()} == brute_clusters(members, pairs)


def test_reclustered_parts_are_the_brute_force_ones(spark):
    """The registered query on the smallest tables."""
    from citeweave.plans.citations import QUERIES

    path = "/root/testdata/sf0.001"
    p = spark.read.parquet(f"{path}/part.parquet")
    pairs = match.distances(p, ["p_brand", "p_size"], "p_partkey", {"title": "p_name", "source": "p_type"}).collect()
    group = {x.p_partkey: f"{x.p_brand}/{x.p_size}" for x in p.collect()}
    want = brute_clusters([(g, i) for i, g in group.items()], [(group[x.a], x.a, x.b, x.distance) for x in pairs])
    assert {(x.group, x.id): x.cluster for x in QUERIES["recluster_components"](spark, path).collect()} == want


def test_distances_in_parts_are_those_of_whole_blocks(spark, monkeypatch):
    people = ["Smith J", "J Smith", "Smith John, Lee A", "Lee AB", ""]
    df = spark.createDataFrame([(i, "b" if i < 40 else None if i < 42 else "c", f"title {i % 7}", people[i % 5]) for i in range(60)], "id long, block string, title string, author string")
    fields = {"title": "title", "author": "author"}
    whole = rows(match.distances(df, ["block"], "id", fields), "a", "b", "distance")
    assert len(whole) == 40 * 39 // 2 + 18 * 17 // 2
    monkeypatch.setattr(match, "PART", 7)
    assert rows(match.distances(df, ["block"], "id", fields), "a", "b", "distance") == whole


def brute_emails(names, mails, ratio=2.0):
    """The fixpoint over dictionaries: who an address is of, round by round."""

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    def far(mail, name):
        return sum(edits(p, mail.split("@")[0].lower()) for p in re.split("[ ,.]+", name.lower()))

    papers = {p for p, _ in names}
    people = {p: {n for q, n in names if q == p} for p in papers}
    boxes = {p: {m for q, m in mails if q == p} for p in papers}
    known = {}
    for p in papers:
        if len(people[p]) == 1 and len(boxes[p]) == 1:
            m, n = next(iter(boxes[p])), next(iter(people[p]))
            known[m] = min(known.get(m, n), n)
    while True:
        found = {}
        for p in papers:
            free = people[p] - {known[m] for m in boxes[p] if m in known}
            lone = [m for m in boxes[p] if m not in known]
            if len(lone) == 1:
                found.setdefault(lone[0], set()).update((far(lone[0], n), n) for n in free)
        new = {}
        for m, scored in found.items():
            best = sorted(scored)
            if best and (len(best) == 1 or best[1][0] > ratio * best[0][0]):
                new[m] = best[0][1]
        if not new:
            return known
        known |= new


def test_the_address_query_is_the_brute_force_fixpoint(spark):
    from citeweave.plans.citations import QUERIES

    path = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{path}/orders.parquet").collect()
    names = [(o.o_orderkey, f"Customer {c}") for o in orders for c in ([o.o_custkey] if o.o_orderstatus == "F" else [o.o_custkey, o.o_custkey + 1])]
    mails = [(o.o_orderkey, f"customer{o.o_custkey}@example.org") for o in orders]
    got = {x.mail: x.name for x in QUERIES["email_author_fixpoint"](spark, path).collect()}
    assert got == brute_emails(set(names), set(mails))


def test_emails_find_their_authors(spark):
    names = spark.createDataFrame([(1, "Ann Lee"), (2, "Ann Lee"), (2, "Bo Chan"), (3, "Cy Dodd"), (3, "Eve Fox")], "paper long, name string")
    mails = spark.createDataFrame([(1, "lee@x.org"), (2, "lee@x.org"), (2, "bo.chan@x.org"), (3, "doddcy@x.org")], "paper long, mail string")
    got = dict(rows(graph.resolve_emails(names, mails), "mail", "name"))
    assert got["lee@x.org"] == "Ann Lee" and got["bo.chan@x.org"] == "Bo Chan"


def test_spectrum_of_a_triangle(spark):
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 0), (0, 0)], "src long, dst long")
    assert [round(x, 6) for x in graph.laplacian_spectrum(edges, "src", "dst")] == [0, 3, 3]
    with pytest.raises(ValueError):
        graph.laplacian_spectrum(edges, "src", "dst", most=2)


def test_year_band(spark):
    refs = spark.createDataFrame([("a", 2000)], "k string, y long")
    works = spark.createDataFrame([("a", y) for y in range(1996, 2003)] + [("b", 2000)], "k string, w long")
    assert rows(match.year_band_join(refs, works, "k", "y", "w"), "w") == [(1998,), (1999,), (2000,)]


def test_cascade_order(spark):
    title = "a study of dark matter halos in clusters"
    refs = [(1, f"Smith, {title}, arXiv:1234.5678 (1995)"), (2, f"Smith, {title} (1995)"), (3, f"Smith, {title} (1989)"), (4, f"{title} (1995)"), (5, "Smith, study of dark (1995)"), (6, f"The Smith, {title}")]
    refs = spark.createDataFrame(refs, "ref_id long, ref_string string")
    works = spark.createDataFrame([("w1", title, 1994), ("w0", title, 1994), ("1234.5678", "x", 1990), ("w9", title, 1996)], "work_id string, title string, year int")
    authors = spark.createDataFrame([("w1", "Smith"), ("w0", "Smith"), ("w9", "Smith")], "work_id string, author string")
    assert rows(match.match_references(refs, works, authors), "ref_id", "target", "how") == [(1, "1234.5678", "id"), (2, "w0", "title")]


def test_ratio_test(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 7), ("b", "x", 3), ("b", "y", 6), ("c", "z", 1)], "k string, c string, s int")
    assert rows(match.best_and_second(df, "k", "c", "s"), "k", "c") == [("a", "x"), ("c", "z")]


def test_votes(spark):
    df = spark.createDataFrame([("g", "A", "pmc_oa", "Long title here"), ("g", "B", "pmc_oa_reference", "x"), ("g", "B", "pubmed_api", "x"), ("g", "B", None, "y"), ("h", "D", None, "b"), ("h", "C", None, "a")], "k string, v string, s string, t string")
    assert rows(vote.weighted_vote(df, "k", ["v"], "s"), "k", "value", "weight") == [("g", "A", 7.0), ("h", "C", 0.5)]
    assert rows(vote.mode_vote(df, "k", "v"), "k", "v") == [("g", "B"), ("h", "D")]
    assert rows(vote.title_vote(df, "k", "t"), "k", "t") == [("g", "Long title here"), ("h", "b")]
    lists = spark.createDataFrame([("g", ["a"]), ("g", ["b", "c"]), ("g", ["b", "b"]), ("h", [])], "k string, l array<string>")
    assert rows(vote.longest_list(lists, "k", "l"), "k", "l") == [("g", ["b", "c"])]


def test_unmatched_keeps_interleaved_and_last_sources(spark):
    refs = spark.createDataFrame([("s1", "t1", "r1"), ("s1", "n1", "r2"), ("s2", "t1", "r3"), ("s1", "n2", "r4"), ("s3", "n3", "r5")], "src string, dst string, text string")
    nodes = spark.createDataFrame([("t1",)], "id string")
    assert rows(resolve.unmatched(refs, nodes, "src", "dst", "id", "text"), "src", "n", "refs") == [("s1", 2, ["r2", "r4"]), ("s3", 1, ["r5"])]


def test_matches_both_ways(spark):
    cites = spark.createDataFrame([("a", 1, "T", ["doi:1", "doi:2"]), ("b", 1, "", []), ("c", 1, "T", None)], "source string, cite_order int, title string, ids array<string>")
    works = spark.createDataFrame([("x", "T", ["doi:2"]), ("y", "U", ["doi:1"]), ("a", "T", [])], "target string, title string, ids array<string>")
    got = resolve.match_cites(cites, works)
    assert rows(got, "source", "target", "spotted", "lastmatch") == [("a", "x", 2, "doi:2"), ("a", "y", 1, "doi:1"), ("c", "a", 1, "title:T"), ("c", "x", 1, "title:T")]
    assert rows(resolve.cited_by(got.unionByName(got)), "target", "source") == [("a", "c"), ("x", "a"), ("x", "c"), ("y", "a")]


def test_upsert_keeps_the_batch_s_last(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k int, v string, o int")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, o int")
    assert rows(resolve.upsert(old, new, "k", "o"), "k", "v") == [(1, "a"), (2, "d"), (3, "e")]


def test_pointer_ranges_and_warnings(spark):
    refs = spark.createDataFrame([("d", f"r{i}", i) for i in range(1, 7)], "doc string, ref string, pos int")
    pointers = spark.createDataFrame([("d", 1, "r2", "r5"), ("d", 2, "r4", None), ("d", 3, "r6", "r1")], "doc string, pointer int, first string, last string")
    good, bad = windows.expand_ranges(pointers, refs, "doc")
    assert rows(good, "pointer", "ref") == [(1, "r2"), (1, "r3"), (1, "r4"), (1, "r5"), (2, "r4")]
    assert rows(bad, "pointer") == [(3,)]


def test_histograms_and_facets(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "t string")
    assert [tuple(r) for r in stats.term_facet(df, F.col("t"), 2).collect()] == [("a", 3), ("b", 2)]
    assert [r.term for r in stats.term_facet(df, F.col("t"), 9, "reverse_term").collect()] == ["c", "b", "a"]
    assert sorted(map(tuple, stats.facet_with_other(df, F.col("t"), 1).collect()), key=str) == [("a", 3), (None, 3)]
    assert rows(stats.cluster_sizes(df, "t"), "size", "clusters") == [(0, 1), (1, 1), (2, 1), (3, 1)]
    years = spark.createDataFrame([(1949,), (1950,), (1979,), (1980,), (2011,)], "y int").select(stats.early_bucket(F.col("y")).alias("b"))
    assert [r.b for r in years.collect()] == [None, "EARL", "EARL", "1980", None]


def test_quads_escape_and_reject(spark):
    df = spark.createDataFrame([("w/1", 'say "hi"\n', "ok"), ("bad id", "x", "y"), ("w/2", None, "z z")], "id string, title string, see string")
    out = rdf.lines(rdf.quads(df, F.col("id"), {"title": rdf.literal(F.col("title")), "see": rdf.iri(F.col("see"))}, F.lit("g")))
    assert sorted(r.value for r in out.collect()) == [
        '<http://example.org/w/1> <http://example.org/see> <http://example.org/ok> <http://example.org/g> .',
        '<http://example.org/w/1> <http://example.org/title> "say \\"hi\\"\\n" <http://example.org/g> .',
    ]


def test_ordered_lists_link_items(spark):
    df = spark.createDataFrame([("L", 1, "a"), ("L", 2, "b")], "l string, pos int, item string")
    out = rdf.ordered_list(df, F.col("l"), "l", "pos", F.col("item"), F.lit("g"))
    kinds = sorted(r.p.rpartition("#")[2] for r in out.collect())
    assert kinds == ["firstItem>", "itemContent>", "itemContent>", "lastItem>", "nextItem>"]


def test_graph_queries_over_all_lines(spark, tmp_path):
    from citeweave.plans.citations import QUERIES, SQL

    spark.range(6).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    lines = [(1, 1, 2), (1, 2, 3), (2, 1, 3), (2, 7, 5), (8, 3, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.id: (r.out, r["in"]) for r in QUERIES["neighbour_lists_all_lines"](spark, str(tmp_path)).collect()}
    assert got == {1: ([2, 3], None), 2: ([3, 4, 5], [1]), 3: (None, [1, 2]), 4: (None, [2]), 5: (None, [2])}
    assert {r.id for r in QUERIES["degree_filter_all_lines"](spark, str(tmp_path)).collect()} == {1, 2, 3, 4, 5}
    assert {r.id for r in QUERIES["degree_filter"](spark, str(tmp_path)).collect()} == {1, 2, 3, 4, 5}
    assert all("l_linenumber" not in SQL[k.removesuffix("_all_lines")] for k in SQL if k.endswith("_all_lines"))
