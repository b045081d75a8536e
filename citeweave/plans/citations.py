"""Citation readings of the driver's tables: each query, and the same in SQL.

Works are parts, citing works orders, citations lineitems; authors are customers,
journals suppliers, places nations and regions. Operators take column names, so nothing
in them is tied to these tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeweave.functions import audit, dates, ids, similarity, tex, text, urls
from citeweave.operators import graph, match, rdf, resolve, stats, vote, windows
from citeweave.search.request import Clause, SearchRequest, search, suggest
from citeweave.session import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("""
SELECT p.p_partkey AS work, count(l.l_orderkey) AS n FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey
GROUP BY 1 ORDER BY n DESC, work LIMIT 20""")
def citation_counts_topk(spark, d):
    counts = stats.citation_counts(table(spark, d, "part").select(F.col("p_partkey").alias("work")), table(spark, d, "lineitem"), "work", "l_partkey")
    return counts.orderBy(F.desc("n"), "work").limit(20)


@query("""
SELECT p_partkey AS id, (SELECT count(*) FROM lineitem WHERE l_orderkey = p_partkey) AS n_out,
  (SELECT count(*) FROM lineitem WHERE l_partkey = p_partkey) AS n_in FROM part""")
def reference_counts_zero_filled(spark, d):
    out = stats.degree_counts(table(spark, d, "part"), table(spark, d, "lineitem"), "p_partkey", "l_orderkey", "l_partkey")
    return out.select("id", F.col("n_out").cast("long"), F.col("n_in").cast("long"))


@query("SELECT c_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def author_paper_counts(spark, d):
    counts = stats.author_counts(table(spark, d, "orders").select("o_custkey"), "o_custkey")  # before the join: one row an author
    return counts.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_name").agg(F.sum("n").alias("n"))


@query("""
SELECT l_orderkey, string_agg(s_name, ' and ' ORDER BY l_linenumber, s_name) AS s_name
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1""")
def author_list_joined(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return stats.joined_names(rows, "l_orderkey", "s_name", "l_linenumber")


@query("SELECT event_type AS term, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def term_facet_topn(spark, d):
    return stats.term_facet(table(spark, d, "events"), F.col("event_type"), 3)


@query("""
WITH c AS (SELECT n_name AS term, count(*) AS count FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1),
top AS (SELECT * FROM c ORDER BY count DESC, term LIMIT 10)
SELECT term, count FROM top UNION ALL SELECT NULL, (SELECT sum(count) FROM c)::BIGINT - (SELECT sum(count) FROM top)::BIGINT""")
def facet_other_remainder(spark, d):
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return stats.facet_with_other(rows, F.col("n_name"), 10)


@query("SELECT strftime(o_orderdate, '%Y-%m-01') AS bucket, count(*) AS n FROM orders GROUP BY 1")
def date_histogram_month(spark, d):
    return stats.date_histogram(table(spark, d, "orders"), "o_orderdate", "month").select(F.col("bucket").cast("string"), "n")


@query("""
SELECT event_type, strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS n FROM events
WHERE ts >= (SELECT min(ts) FROM events) AND ts <= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1, 2""")
def date_histogram_filtered_multi(spark, d):
    return stats.date_histogram(table(spark, d, "events"), "ts", "day", hi="2024-01-15 00:00:00", by=["event_type"]).select("event_type", F.col("bucket").cast("string"), "n")


@query("""
SELECT c.c_custkey AS record_id, coalesce(CAST(min(n.n_nationkey) AS VARCHAR), '') AS known, min(n.n_nationkey) IS NULL AS is_new
FROM customer c LEFT JOIN nation n ON (n.n_nationkey = c.c_nationkey OR n.n_nationkey = c.c_custkey % 50) AND n.n_regionkey < 2 GROUP BY 1""")
def identifier_lookup_or_new(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("record_id"), "c_nationkey")
    keys = F.array(ids.canonical(F.lit("nation"), F.col("c_nationkey").cast("string")), ids.canonical(F.lit("nation"), (F.col("record_id") % 50).cast("string")))
    known = table(spark, d, "nation").where("n_regionkey < 2").select(ids.canonical(F.lit("nation"), F.col("n_nationkey").cast("string")).alias("canonical"), F.col("n_nationkey").alias("id"))
    found = resolve.lookup_or_new(c, c.select("record_id", F.explode(keys).alias("canonical")), known)
    return found.select("record_id", F.when(F.col("is_new"), F.lit("")).otherwise(F.col("id")).alias("known"), "is_new")


@query("""
WITH docs AS (SELECT doc_id, split_part(text, '.', 1) AS title, ['lang:' || lang || ':' || n_chars, 'src:' || source || ':' || (doc_id % 97)] AS ids FROM documents),
keys AS (SELECT doc_id, 0 AS ord, 'title:' || title AS key FROM docs WHERE title <> ''
  UNION ALL SELECT doc_id, u.ord, u.key FROM docs, LATERAL (SELECT unnest(ids) AS key, generate_subscripts(ids, 1) AS ord) u)
SELECT a.doc_id AS source, 1 AS cite_order, b.doc_id AS target, count(*) AS spotted, max_by(a.key, a.ord) AS lastmatch
FROM keys a JOIN (SELECT DISTINCT doc_id, key FROM keys) b ON a.key = b.key AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3""")
def match_cites_two_key(spark, d):
    """Documents that name each other by first sentence or by either of two identifiers."""
    docs = table(spark, d, "documents")
    keys = F.array(F.concat_ws(":", F.lit("lang"), "lang", "n_chars"), F.concat_ws(":", F.lit("src"), "source", F.col("doc_id") % 97))
    rows = docs.select("doc_id", F.substring_index("text", ".", 1).alias("title"), keys.alias("ids"))
    citing = rows.select(F.col("doc_id").alias("source"), F.lit(1).alias("cite_order"), "title", "ids")
    return resolve.match_cites(citing, rows.select(F.col("doc_id").alias("target"), "title", "ids"))


@query("""
SELECT a.o_orderkey AS ref, b.o_orderkey AS work FROM orders a JOIN orders b
ON a.o_custkey = b.o_custkey AND a.o_orderkey <> b.o_orderkey AND year(b.o_orderdate) BETWEEN year(a.o_orderdate) - 2 AND year(a.o_orderdate)""")
def year_band_join(spark, d):
    o = table(spark, d, "orders")
    refs = o.select("o_custkey", F.col("o_orderkey").alias("ref"), F.year("o_orderdate").alias("ry"))
    works = o.select("o_custkey", F.col("o_orderkey").alias("work"), F.year("o_orderdate").alias("wy"))
    return match.year_band_join(refs, works, "o_custkey", "ry", "wy").where("ref <> work").select("ref", "work")


@query("""
SELECT o.o_custkey, count(*) AS n, list_sort(list(o.o_orderpriority)) AS refs FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey AND c_mktsegment = 'BUILDING') GROUP BY 1""")
def unmatched_refs(spark, d):
    nodes = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'")
    refs = table(spark, d, "orders").select("o_custkey", F.col("o_custkey").alias("target"), "o_orderpriority")
    return resolve.unmatched(refs, nodes, "o_custkey", "target", "c_custkey", "o_orderpriority")


@query("""
WITH lookup AS (SELECT p_partkey, max(p_size) AS v FROM part WHERE p_size > 25 GROUP BY 1)
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_linenumber = 1 THEN l_suppkey END, v) AS resolved
FROM lineitem LEFT JOIN lookup ON p_partkey = l_partkey WHERE l_linenumber = 1 OR v IS NOT NULL""")
def pmid_pmc_coalesce_join(spark, d):
    refs = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") == 1, F.col("l_suppkey")).alias("direct"))
    lookup = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return resolve.coalesce_lookup(refs, lookup, "l_partkey", "direct", "p_size").select("l_orderkey", "l_linenumber", F.col("resolved").cast("long"))


@query("""
SELECT a.p_size + 1000 * (l_orderkey % 100) AS src, b.p_size AS dst FROM lineitem
JOIN part a ON a.p_partkey = l_orderkey % 199 + 1 JOIN part b ON b.p_partkey = l_partkey""")
def id_remap_edges(spark, d):
    edges = table(spark, d, "lineitem").select((F.col("l_orderkey") % 199 + 1).alias("src"), F.col("l_partkey").alias("dst"), (F.col("l_orderkey") % 100).alias("k"))
    mapping = table(spark, d, "part").select(F.col("p_partkey").alias("old"), F.col("p_size").alias("new"))
    return resolve.remap(edges, mapping, "src", "dst").select((F.col("src") + 1000 * F.col("k")).alias("src"), "dst")


@query("""
SELECT a.o_orderkey AS src FROM orders a WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = a.o_orderkey)""")
def unmapped_edge_ends(spark, d):
    edges = table(spark, d, "orders").select(F.col("o_orderkey").alias("src"), F.lit(1).cast("long").alias("dst"))
    return resolve.unmapped(edges, table(spark, d, "part").select(F.col("p_partkey").alias("old"), F.col("p_partkey").alias("new")), "src", "dst").select(F.col("old").alias("src"))


@query("""
WITH v AS (SELECT user_id, f.field, f.value, sum(CASE event_type WHEN 'purchase' THEN 7.0 WHEN 'click' THEN 1.0 WHEN 'view' THEN 2.0 ELSE 0.5 END) AS weight
  FROM events, LATERAL (SELECT 'kind' AS field, event_type AS value UNION ALL SELECT 'hour', CAST(hour(ts) AS VARCHAR)) f GROUP BY 1, 2, 3)
SELECT user_id, field, value, weight FROM v QUALIFY row_number() OVER (PARTITION BY user_id, field ORDER BY weight DESC, value) = 1""")
def weighted_majority_vote(spark, d):
    rows = table(spark, d, "events").select("user_id", F.col("event_type").alias("kind"), F.hour("ts").alias("hour"), "event_type")
    return vote.weighted_vote(rows, "user_id", ["kind", "hour"], "event_type", {"purchase": 7.0, "click": 1.0, "view": 2.0})


@query("""
WITH c AS (SELECT p_brand, trim(regexp_replace(p_name, '\\s+', ' ', 'g')) AS v, count(*) AS n FROM part GROUP BY 1, 2)
SELECT p_brand, v AS p_name, n FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, v DESC) = 1""")
def mode_vote(spark, d):
    return vote.mode_vote(table(spark, d, "part"), "p_brand", "p_name")


@query("""
WITH c AS (SELECT p_brand, p_name AS v, count(*) * length(p_name) * length(p_name) AS r FROM part GROUP BY p_brand, p_name)
SELECT p_brand, v AS p_name FROM c QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY r DESC, v DESC) = 1""")
def title_vote(spark, d):
    return vote.title_vote(table(spark, d, "part"), "p_brand", "p_name")


@query("""
SELECT p_brand, list_sort(list_distinct(flatten(list(string_split(p_name, ' '))))) AS words FROM part GROUP BY 1""")
def keyword_union(spark, d):
    return vote.keyword_union(table(spark, d, "part"), "p_brand", "p_name", " ").withColumnRenamed("p_name", "words")


@query("""
SELECT concat_ws(',', CASE WHEN regexp_matches(text, '[0-9a-f]{24}') THEN 'hex' END, CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,4}') THEN 'mail' END,
  CASE WHEN regexp_matches(text, '[12][0-9]{3}') THEN 'year' END) AS kinds, count(*) AS n FROM documents GROUP BY 1""")
def identifier_prevalence(spark, d):
    t = F.col("text")
    return stats.identifier_prevalence(table(spark, d, "documents"), {"hex": t.rlike("[0-9a-f]{24}"), "mail": t.rlike("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,4}"), "year": t.rlike("[12][0-9]{3}")})


@query("""
SELECT year(l_shipdate) AS citing_year, year(o_orderdate) AS cited_year, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE year(l_shipdate) BETWEEN 1980 AND 2010 AND year(o_orderdate) BETWEEN 1980 AND 2010 GROUP BY 1, 2""")
def year_matrix(spark, d):
    rows = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return stats.year_matrix(rows, F.year("l_shipdate"), F.year("o_orderdate"), 1980, 2010)


@query("""
WITH g AS (SELECT p_brand, list(DISTINCT p_type) AS kinds, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand, list_filter(['PROMO', 'ECONOMY', 'STANDARD'], lambda p: list_contains(kinds, p))[1] AS p_type, n FROM g""")
def type_hierarchy_resolution(spark, d):
    return stats.resolve_type(table(spark, d, "part"), "p_brand", "p_type", ["PROMO", "ECONOMY", "STANDARD"])


@query("""
WITH s AS (SELECT count(*) AS size FROM orders WHERE o_custkey % 10 <> 0 GROUP BY o_custkey),
h AS (SELECT size, count(*) AS clusters FROM s GROUP BY 1 UNION ALL SELECT 0, count(*) FROM orders WHERE o_custkey % 10 = 0)
SELECT size, clusters, CAST(floor(log2(clusters) + 1) AS BIGINT) AS bar FROM h WHERE clusters > 0""")
def cluster_size_histogram(spark, d):
    return stats.cluster_sizes(table(spark, d, "orders").select(F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("g")), "g")


@query("""
WITH c AS (SELECT count(*) AS size FROM lineitem GROUP BY l_partkey) SELECT size, count(*) AS groups, size >= 40 AS highly FROM c GROUP BY 1""")
def citation_histogram(spark, d):
    return stats.count_histogram(table(spark, d, "lineitem"), "l_partkey", 40)


@query("""
SELECT event_type, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 6) AS value, round(avg(CASE WHEN props LIKE '%1%' THEN 1.0 ELSE 0.0 END), 6) AS props,
  round((avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END) + avg(CASE WHEN props LIKE '%1%' THEN 1.0 ELSE 0.0 END)) / 2, 6) AS mean FROM events GROUP BY 1""")
def field_coverage(spark, d):
    out = stats.field_coverage(table(spark, d, "events"), "event_type", {"value": F.coalesce(F.col("value") > 50, F.lit(False)), "props": F.coalesce(F.contains("props", F.lit("1")), F.lit(False))})
    return out.select("event_type", *[F.round(c, 6).alias(c) for c in ("value", "props", "mean")])


_TOPICS = {"the": "(^| )the( |$)", "que": "(^| )que( |$)", "der": "(^| )der( |$)"}
_TOPIC_SQL = """
WITH cited AS (SELECT l_partkey AS doc_id, count(*) AS citations FROM lineitem GROUP BY 1),
hits AS (SELECT t.topic, d.doc_id, coalesce(c.citations, 0) AS citations, coalesce(l.quality = 1, false) AS open
  FROM documents d JOIN (VALUES ('the', '(^| )the( |$)'), ('que', '(^| )que( |$)'), ('der', '(^| )der( |$)')) t(topic, p) ON regexp_matches(d.text, t.p)
  LEFT JOIN cited c USING (doc_id) LEFT JOIN labels l USING (doc_id))
"""


def _topics(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    cited = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("doc_id")).agg(F.count("*").alias("citations"))
    return stats.topic_stats(docs, _TOPICS, "text", "doc_id", F.coalesce(F.col("quality") == 1, F.lit(False)), cited)


@query(_TOPIC_SQL + """
SELECT topic, rank, doc_id, citations FROM (SELECT topic, doc_id, citations, row_number() OVER (PARTITION BY topic ORDER BY citations DESC, doc_id) AS rank FROM hits) WHERE rank <= 20""")
def topic_stats_top20(spark, d):
    return _topics(spark, d)[1]


@query(_TOPIC_SQL + """
SELECT topic, count(*) AS n, count(*) FILTER (open) AS n_open, count(*) FILTER (open AND citations > 0) AS n_open_cited, CAST(sum(citations) AS BIGINT) AS citations FROM hits GROUP BY 1""")
def topic_stats_counts(spark, d):
    return _topics(spark, d)[0]


@query("""
WITH s AS (SELECT s_suppkey, c.n_name, levenshtein(c.n_name, o.n_name[1:3] || '_' || o.n_name[5:]) AS score
  FROM supplier JOIN nation o ON o.n_nationkey = s_nationkey JOIN nation c ON c.n_nationkey % 5 = o.n_nationkey % 5),
r AS (SELECT *, row_number() OVER w AS k, lead(score) OVER w AS second FROM s WINDOW w AS (PARTITION BY s_suppkey ORDER BY score, n_name))
SELECT s_suppkey, n_name, score AS best, second FROM r WHERE k = 1 AND (second IS NULL OR second > 1.5 * score)""")
def best_vs_second_ratio(spark, d):
    """Garbled nation names against those of every fifth nation."""
    nation = table(spark, d, "nation")
    own = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.concat(F.substring("n_name", 1, 3), F.lit("_"), F.expr("substring(n_name, 5)")).alias("wanted"))
    rows = table(spark, d, "supplier").join(own, "s_nationkey").withColumn("k", F.col("s_nationkey") % 5)
    scores = rows.join(nation.withColumn("k", F.col("n_nationkey") % 5), "k").select("s_suppkey", "n_name", F.levenshtein("n_name", "wanted").alias("score"))
    return match.best_and_second(scores, "s_suppkey", "n_name", "score", 1.5)


@query("""
WITH s AS (SELECT p_partkey, regexp_replace(lower(regexp_replace(p_name, '[!-/:-@\\[-`{-~\\s]+', '-', 'g')), '-+$', '') AS slug FROM part)
SELECT p_partkey, CASE WHEN k > 1 THEN slug || '-' || k ELSE slug END AS slug FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY p_partkey) AS k FROM s)""")
def slug_numbering(spark, d):
    return windows.number_duplicates(table(spark, d, "part").select("p_partkey", text.slug(F.col("p_name")).alias("slug")), "slug", "p_partkey")


@query("""
SELECT conv_id, turn, lead(turn) OVER w AS next, lag(turn) OVER w IS NULL AS is_first, lead(turn) OVER w IS NULL AS is_last
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def ordered_list_links(spark, d):
    return windows.link_next(table(spark, d, "conversations").select("conv_id", "turn"), "conv_id", "turn")


@query("""
SELECT p_brand, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS group_id, p_partkey FROM part""")
def dense_group_numbers(spark, d):
    return windows.dense_ids(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand")


@query("""
WITH t AS (SELECT item_id, list_filter(string_split_regex(lower(array_to_string(string_split(text, ' ')[1:12], ' ')), '[^a-z]+'), lambda x: x <> '') AS t FROM benchmark),
w AS (SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '')) AS r FROM documents)
SELECT item_id, doc_id, round(len(list_intersect(t, r)) / len(t), 6) AS coverage FROM t, w WHERE len(t) > 0 AND len(list_intersect(t, r)) / len(t) > 0.7""")
def title_token_coverage(spark, d):
    """The first twelve words of each benchmark item as a title, against all documents; pairs that cover more than 0.7 of the title."""
    titles = table(spark, d, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 12), " ").alias("title"))
    found = match.covering(titles, table(spark, d, "documents"), "item_id", "title", "doc_id", "text")
    return found.select("item_id", "doc_id", F.round("coverage", 6).alias("coverage"))


@query("""
WITH t AS (SELECT item_id, list_distinct(list_filter(string_split_regex(lower(array_to_string(string_split(text, ' ')[1:12], ' ')), '[^a-z]+'), lambda x: x <> '')) AS t FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> ''))) AS word FROM documents),
w AS (SELECT word, CAST(round(ln(1 + (SELECT count(*) FROM documents) / count(*)) * 1000000) AS BIGINT) AS w FROM d GROUP BY word),
s AS (SELECT item_id, doc_id, CAST(sum(w) AS BIGINT) AS score FROM (SELECT item_id, unnest(t) AS word FROM t) JOIN w USING (word) JOIN d USING (word) GROUP BY 1, 2)
SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 8""")
def title_search(spark, d):
    """The eight documents that share most with the first twelve words of each benchmark item."""
    titles = table(spark, d, "benchmark").select("item_id", F.array_join(F.slice(F.split("text", " "), 1, 12), " ").alias("title"))
    return match.top_candidates(titles, table(spark, d, "documents"), "item_id", "title", "doc_id", "text")


@query(r"""
WITH t AS (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN ' (' || (1700 + doc_id % 400) || ') ' WHEN doc_id % 3 = 1 THEN ' ' || (1700 + doc_id % 400) || '.' ELSE '' END AS s FROM documents),
y AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(s, '\((\d{4})\)', 1), lambda x: CAST(x AS INTEGER)), lambda x: x >= 1800 AND x <= 2050) AS p,
  list_filter(list_transform(regexp_extract_all(s, '\b(\d{4})\b', 1), lambda x: CAST(x AS INTEGER)), lambda x: x >= 1800 AND x <= 2020) AS b FROM t)
SELECT doc_id, coalesce(p[len(p)], b[len(b)]) AS year FROM y""")
def guess_year_text(spark, d):
    docs, year = table(spark, d, "documents"), (F.col("doc_id") % 400 + 1700).cast("string")
    tail = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(" ("), year, F.lit(") "))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit(" "), year, F.lit("."))).otherwise(F.lit(""))
    return docs.select("doc_id", text.guess_year(F.concat("text", tail)).alias("year"))


@query("""
WITH p AS (SELECT *, p_partkey % 40 AS vol, 1950 + p_partkey % 60 AS yr FROM part),
sim AS (SELECT a.p_partkey AS a, b.p_partkey AS b,
  1 - levenshtein(lower(a.p_name), lower(b.p_name)) / greatest(length(a.p_name), length(b.p_name)) AS st,
  1 - levenshtein(lower(a.p_type), lower(b.p_type)) / greatest(length(a.p_type), length(b.p_type)) AS ss,
  1 - levenshtein(CAST(a.vol AS VARCHAR), CAST(b.vol AS VARCHAR)) / greatest(length(CAST(a.vol AS VARCHAR)), length(CAST(b.vol AS VARCHAR))) AS sv,
  pow(2.0, -abs(a.yr - b.yr) / 3) AS sy
  FROM p a JOIN p b ON a.p_brand = b.p_brand AND a.p_size = b.p_size AND a.p_partkey < b.p_partkey)
SELECT a, b, round((1 + 0.4 + 0.4 + 0.5) / (st + 0.4 * ss + 0.4 * sv + 0.5 * sy) - 1, 6) AS distance FROM sim""")
def similarity_distance(spark, d):
    p = table(spark, d, "part").select("*", (F.col("p_partkey") % 40).cast("string").alias("vol"), (1950 + F.col("p_partkey") % 60).cast("string").alias("yr"))
    out = match.distances(p, ["p_brand", "p_size"], "p_partkey", {"title": "p_name", "source": "p_type", "volume": "vol", "year": "yr"})
    return out.select("a", "b", F.round("distance", 6).alias("distance"))


@query(r"""
WITH u AS (SELECT page_id, regexp_replace(trim(url), '[\s\])>.,;]+$', '') AS u FROM pages),
p AS (SELECT page_id, u, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme, lower(regexp_extract(u, '://([^/?#:]*)', 1)) AS host, regexp_extract(u, '://[^/?#]*(.*)$', 1) AS rest FROM u)
SELECT page_id, host, scheme || '://' || host || CASE WHEN rest LIKE '/%' THEN rest ELSE '/' || rest END AS url FROM p""")
def sanitize_url_host(spark, d):
    good = urls.normal_url(F.col("url"))
    return table(spark, d, "pages").select("page_id", urls.host_of(good).alias("host"), good.alias("url"))


@query("SELECT lower(regexp_extract(url, '://([^/?#:]*)', 1)) AS term, count(*) AS count FROM pages GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def url_frequency_top10(spark, d):
    return stats.value_counts(table(spark, d, "pages"), urls.host_of(urls.normal_url(F.col("url"))))


@query(r"""
SELECT doc_id, list_sort(list_distinct(regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4})', 1))) AS mails
FROM documents WHERE regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,4}')""")
def emails_per_doc(spark, d):
    found = table(spark, d, "documents").select("doc_id", F.array_sort(text.emails(F.col("text"))).alias("mails"))
    return found.where(F.size("mails") > 0)


@query(r"""
WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, '.'), lambda x: trim(regexp_replace(x, '[^A-Za-z ]', '', 'g'))), lambda x: x <> '') AS s FROM documents)
SELECT doc_id, CAST(u.i AS INTEGER) AS pos, u.x AS item FROM s, LATERAL (SELECT unnest(s) AS x, generate_subscripts(s, 1) AS i) u""")
def bibitem_split(spark, d):
    r"""Sentences written as a TeX bibliography, and read back as its items."""
    plain = F.filter(F.transform(F.split("text", r"\."), lambda x: F.trim(F.regexp_replace(x, "[^A-Za-z ]", ""))), lambda x: x != "")
    items = F.array_join(F.transform(plain, lambda x: F.concat(F.lit("\\bibitem{k} "), x, F.lit(" % note\n"))), "")
    source = F.concat(F.lit("\\begin{thebibliography}{9}\n"), items, F.lit("\\end{thebibliography}"))
    rows = table(spark, d, "documents").select("doc_id", tex.bibitems(source).alias("items"))
    return windows.with_position(rows, "items").select("doc_id", "pos", "item")


@query(r"""
WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size || ' (Pt 3)' WHEN 1 THEN p_size || ' Suppl 2' WHEN 2 THEN p_size || ';7' WHEN 3 THEN chr(8722) || p_size ELSE CAST(p_size AS VARCHAR) END AS volume,
  CASE WHEN p_partkey % 7 = 0 THEN 'Pt 4' END AS issue FROM part),
s AS (SELECT p_partkey, volume, issue, CASE WHEN issue IS NULL THEN coalesce(nullif(regexp_extract(volume, '^(\d+)[ (]+Pt (\d+)\)?$', 2), ''), nullif(regexp_extract(volume, '^(\d+) Suppl (\d+)$', 2), ''), nullif(regexp_extract(volume, '^(\d+);(\d+)$', 2), '')) END AS split FROM p)
SELECT p_partkey, replace(CASE WHEN split IS NOT NULL THEN regexp_extract(volume, '^(\d+)', 1) ELSE volume END, chr(8722), '-') AS volume, CASE WHEN issue = 'Pt 4' THEN '4' ELSE coalesce(split, issue) END AS issue,
  CAST((split IS NOT NULL)::INT + contains(volume, chr(8722))::INT + coalesce((issue = 'Pt 4')::INT, 0) AS INTEGER) AS n_errors FROM s""")
def sanitize_volume_issue_audit(spark, d):
    size, k = F.col("p_size").cast("string"), F.col("p_partkey") % 5
    volume = F.when(k == 0, F.concat(size, F.lit(" (Pt 3)"))).when(k == 1, F.concat(size, F.lit(" Suppl 2"))).when(k == 2, F.concat(size, F.lit(";7"))).when(k == 3, F.concat(F.lit("−"), size)).otherwise(size)
    rows = table(spark, d, "part").select("p_partkey", volume.alias("volume"), F.when(F.col("p_partkey") % 7 == 0, F.lit("Pt 4")).alias("issue"))
    return audit.sanitize_issue(audit.sanitize_volume(rows)).select("p_partkey", "volume", "issue", F.size("errors").alias("n_errors"))


@query("""
WITH RECURSIVE k AS (SELECT o_orderkey AS r, 'c' || o_custkey || strftime(o_orderdate, ':%Y') AS id FROM orders
  UNION SELECT l_orderkey, 'p' || l_partkey || strftime(l_shipdate, ':%Y-%m-%d') FROM lineitem),
e AS (SELECT DISTINCT a.r AS a, b.r AS b FROM k a JOIN k b USING (id) WHERE a.r <> b.r),
c AS (SELECT DISTINCT r AS node, r AS root FROM k UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.node)
SELECT node AS record, min(root) AS "group" FROM c GROUP BY 1""")
def connected_components(spark, d):
    """Orders that share a customer's year, or a part shipped on one day."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("record"), F.lit("c").alias("scheme"), F.concat_ws(":", "o_custkey", F.date_format("o_orderdate", "yyyy")).alias("value"))
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), F.lit("p").alias("scheme"), F.concat_ws(":", "l_partkey", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("value"))
    return graph.unify(o.unionByName(s), "record", "scheme", "value")


def _graph(spark, d):
    """Parts as works; each line cites its part from the part that its order's number falls on."""
    part, item = table(spark, d, "part"), table(spark, d, "lineitem")
    n = part.count()  # from the files' footers
    edges = item.select((F.col("l_orderkey") % n).alias("src"), F.col("l_partkey").alias("dst")).distinct()
    return part.select(F.col("p_partkey").alias("id")), edges


_EDGES = "e AS (SELECT DISTINCT l_orderkey % (SELECT count(*) FROM part) AS src, l_partkey AS dst FROM lineitem)"
_ROUND = "r{i} AS (SELECT p_partkey AS id, 0.15 + 0.85 * coalesce(g, 0) AS rank FROM part LEFT JOIN (SELECT e.dst, sum(r.rank / o.refs) AS g FROM e JOIN r{j} r ON r.id = e.src JOIN o USING (src) GROUP BY 1) ON dst = p_partkey)"


@query(f"WITH {_EDGES}, o AS (SELECT src, count(*) AS refs FROM e GROUP BY 1), r0 AS (SELECT p_partkey AS id, 1.0::DOUBLE AS rank FROM part), " + ", ".join(_ROUND.format(i=i, j=i - 1) for i in range(1, 5)) + " SELECT id, round(rank, 8) AS rank FROM r4")
def citerank_4(spark, d):
    return graph.cite_rank(*_graph(spark, d)).select("id", F.round("rank", 8).alias("rank"))


@query(f"""WITH RECURSIVE {_EDGES}, r AS (SELECT p_partkey AS id, 0 AS level FROM part WHERE p_partkey < 5 UNION SELECT e.dst, r.level + 1 FROM r JOIN e ON e.src = r.id WHERE r.level < 4)
SELECT id, min(level) AS level FROM r GROUP BY 1""")
def bfs_levels(spark, d):
    nodes, edges = _graph(spark, d)
    return graph.bfs(nodes.where("id < 5"), edges, 4)


@query(f"WITH {_EDGES} SELECT p_partkey AS id FROM part WHERE p_partkey IN (SELECT src FROM e UNION SELECT dst FROM e)")
def degree_filter(spark, d):
    nodes, edges = _graph(spark, d)
    return graph.drop_isolated(nodes, edges, "id", "src", "dst")


@query(f"""WITH {_EDGES}, a AS (SELECT 'cited' AS side, dst AS id, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'citing', src, count(*) FROM e GROUP BY 2)
SELECT side, rank, id, n FROM (SELECT *, row_number() OVER (PARTITION BY side ORDER BY n DESC, id) AS rank FROM a) WHERE rank <= 5""")
def top_cited_citing(spark, d):
    return stats.top_degree(_graph(spark, d)[1], "src", "dst")


@query(f"""WITH {_EDGES}, o AS (SELECT src AS id, list_sort(list(dst)) AS out FROM e GROUP BY 1), i AS (SELECT dst AS id, list_sort(list(src)) AS "in" FROM e GROUP BY 1)
SELECT coalesce(o.id, i.id) AS id, out, "in" FROM o FULL JOIN i ON o.id = i.id""")
def neighbour_lists(spark, d):
    return graph.neighbours(_graph(spark, d)[1], "src", "dst")


# The names under which these were first held to all lines.
for _f in (citerank_4, bfs_levels, degree_filter, top_cited_citing, neighbour_lists):
    QUERIES[f"{_f.__name__}_all_lines"], SQL[f"{_f.__name__}_all_lines"] = _f, SQL[_f.__name__]


@query()
def email_author_fixpoint(spark, d):
    """Each order is a paper of its customer; those not filled yet have the next customer as second author. One address a paper."""
    papers = table(spark, d, "orders").select(F.col("o_orderkey").alias("paper"), "o_custkey", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey") + 1).alias("second"))
    who = papers.select("paper", F.explode(F.array("o_custkey", "second")).alias("c")).where("c IS NOT NULL")
    mails = papers.select("paper", F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.org")).alias("mail"))
    return graph.resolve_emails(who.select("paper", F.concat(F.lit("Customer "), F.col("c").cast("string")).alias("name")), mails)


@query()
def recluster_components(spark, d):
    """Parts of a brand and size; those without distance to each other are one to the pairs, the least of them, and share its cluster."""
    p, block, fields = table(spark, d, "part"), ["p_brand", "p_size"], {"title": "p_name", "source": "p_type"}
    group = p.select(F.concat_ws("/", *block).alias("group"), F.col("p_partkey").alias("id"))
    same = materialize(match.representatives(p, block, "p_partkey", fields).distinct().join(group.distinct(), "id"), "same")
    least = p.join(same.where("id = least").select(F.col("id").alias("p_partkey")), "p_partkey", "left_semi")
    pairs = match.distances(least, block, "p_partkey", fields).where("distance <= 0.9").join(group.withColumnRenamed("id", "a"), "a").select("group", "a", "b", "distance")
    found = graph.recluster(pairs, same.select("group", F.col("least").alias("id")), 0.9).withColumnRenamed("id", "least")
    return same.join(found, ["group", "least"]).select("group", "id", "cluster")


@query("""
WITH t AS (SELECT DISTINCT doc_id, unnest([lang, source]) AS term FROM documents), top AS (SELECT term, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, term LIMIT 10)
SELECT term, doc_id FROM t WHERE term IN (SELECT term FROM top)""")
def facet_graph_links(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.array("lang", "source").alias("terms"))
    return graph.facet_graph(docs, "doc_id", "terms")[1]


@query("""
SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase') AND value BETWEEN 10.0 AND 90.0 AND NOT user_id = 7
ORDER BY value DESC, event_id LIMIT 25 OFFSET 50""")
def search_bool_range_page(spark, d):
    request = SearchRequest(
        must=[Clause("any_of", "event_type", ["click", "purchase"]), Clause("range", "value", lo=10.0, hi=90.0)], must_not=[Clause("term", "user_id", 7)],
        sort=[("value", "desc"), ("event_id", "asc")], offset=50, size=25, fields=["event_id", "event_type", "value"],
    )
    return search(table(spark, d, "events"), SearchRequest.from_json(request.to_json())).hits


@query("""SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity BETWEEN 45 AND 50 GROUP BY 1""")
def nested_exists_filter(spark, d):
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", "l_quantity")).alias("items"))
    request = SearchRequest(must=[Clause("nested", "items", clauses=[Clause("term", "l_returnflag", "R"), Clause("range", "l_quantity", lo=45, hi=50)])], size=10**9, fields=["l_orderkey"])
    return search(items, request).hits


@query("SELECT c_name AS term, count(*) AS count FROM customer WHERE contains(lower(c_name), '12') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50")
def suggest_prefix(spark, d):
    return suggest(table(spark, d, "customer"), "c_name", "12", 50)


@query("""
SELECT doc_id FROM documents WHERE list_contains(string_split_regex(lower(text), '\\W+'), 'the') AND regexp_matches(lower(text), '(^|\\W)ing\\w*($|\\W)') OR contains(lower(text), 'de la')""")
def search_query_string(spark, d):
    request = SearchRequest(must=[Clause("query_string", "text", 'the AND ing* OR "de la"')], size=10**9, fields=["doc_id"])
    return search(table(spark, d, "documents"), request).hits


@query("""SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_ingest_equals_batch(spark, d):
    """Events streamed in and upserted by user: what is left is each user's last one."""
    from citeweave.session import scratch_path
    from citeweave.streaming import ingest

    columns = ["event_id", "ts", "user_id", "event_type", "value"]
    landing, store, state = (scratch_path(spark, n) for n in ("landing", "store", "state"))
    rows = table(spark, d, "events").select(*columns).withColumn("seq", F.struct("ts", "event_id"))
    rows.repartition(4, "event_id").write.parquet(landing)
    stream = ingest.file_stream(spark, landing, rows.schema)
    ingest.drain(stream, state, ingest.upsert_batches(spark, store, "user_id", "seq"))
    return ingest.current(spark, store, "user_id", "seq").select(*columns)


@query(r"""
SELECT '<http://example.org/nation/' || n_nationkey || '> <http://example.org/' || p || '> ' || o || ' <http://example.org/graph/' || n_regionkey || '> .' AS value FROM nation,
LATERAL (SELECT 'name' AS p, '"' || n_name || '"' AS o UNION ALL SELECT 'region', '<http://example.org/region/' || n_regionkey || '>')""")
def nquads_rows(spark, d):
    key = F.concat(F.lit("nation/"), F.col("n_nationkey").cast("string"))
    region = F.concat(F.lit("region/"), F.col("n_regionkey").cast("string"))
    rows = rdf.quads(table(spark, d, "nation"), key, {"name": rdf.literal(F.col("n_name")), "region": rdf.iri(region)}, F.concat(F.lit("graph/"), F.col("n_regionkey").cast("string")))
    return rdf.lines(rows)


@query("""
SELECT o_orderkey, 'j:' || md5(o_orderpriority || o_orderstatus || CAST(year(o_orderdate) AS VARCHAR) || '') AS content_id, strftime(o_orderdate, '%d/%m/%Y') AS date,
  strftime(o_orderdate, '%Y-%m-01') AS iso FROM orders""")
def content_ids_and_dates(spark, d):
    o, y = table(spark, d, "orders"), F.year("o_orderdate").cast("string")
    m, day = F.month("o_orderdate").cast("string"), F.dayofmonth("o_orderdate").cast("string")
    return o.select("o_orderkey", ids.content_id("j", F.col("o_orderpriority"), F.col("o_orderstatus"), y, F.lit(None)).alias("content_id"), dates.day_month_year(y, m, day).alias("date"), dates.iso_date(y, m, F.lit(None)).alias("iso"))


@query(r"""
SELECT p_partkey, (1000 + p_partkey % 500) || CASE WHEN p_size % 4 = 0 THEN '' ELSE '-' || (1000 + (p_partkey % 500) // 10 * 10 + p_size % 10) END AS pages,
  CASE p_partkey % 4 WHEN 0 THEN '10.1234/a' || p_size WHEN 1 THEN '10.1234/b' || p_size WHEN 2 THEN '10.1234/c' || p_size END AS doi,
  'hep-th/' || lpad(CAST(p_partkey % 10000000 AS VARCHAR), 7, '0') AS preprint FROM part""")
def identifier_repairs(spark, d):
    size = F.col("p_size").cast("string")
    first = (1000 + F.col("p_partkey") % 500).cast("string")
    last = F.when(F.col("p_size") % 4 != 0, (F.col("p_size") % 10).cast("string"))
    k = F.col("p_partkey") % 4
    doi = F.when(k == 0, F.concat(F.lit("1234/a"), size)).when(k == 1, F.concat(F.lit("10:1234/b"), size)).when(k == 2, F.concat(F.lit("10.1234/c"), size)).otherwise(F.lit("none"))
    old = F.concat(F.lit("hep-th"), F.lpad((F.col("p_partkey") % 10000000).cast("string"), 7, "0"))
    last_full = F.when(last.isNotNull(), ids.complete_last_page(first, last))
    pages = F.when(last_full.isNull(), first).otherwise(F.concat(first, F.lit("-"), last_full))
    return table(spark, d, "part").select("p_partkey", pages.alias("pages"), ids.repair_doi(doi).alias("doi"), ids.repair_preprint_id(old).alias("preprint"))


@query(r"""
WITH r AS (SELECT p_partkey AS ref_id, p_partkey % 3 AS k, p_partkey % 100 AS a, 1985 + p_partkey % 20 AS y, p_name AS t FROM part),
w AS (SELECT p_partkey AS work_id, p_name AS title, 1985 + p_partkey % 20 AS year, p_partkey % 100 AS a FROM part),
pairs AS (SELECT r.ref_id, min(CAST(w.work_id AS VARCHAR)) AS target FROM r JOIN w ON r.a = w.a AND w.year BETWEEN r.y - 2 AND r.y AND r.y >= 1990 AND r.k <> 0 AND w.title = r.t GROUP BY 1)
SELECT ref_id, 'hep-th/' || lpad(CAST(ref_id AS VARCHAR), 7, '0') AS target, 'id' AS how FROM r WHERE k = 0
UNION ALL SELECT ref_id, target, 'title' FROM pairs""")
def reference_cascade(spark, d):
    """References made from parts: a third name an id, the others an author, a year and a title."""
    p = table(spark, d, "part")
    letters = F.translate((F.col("p_partkey") % 100).cast("string"), "0123456789", "abcdefghij")
    author, year = F.concat(F.lit("Xx"), letters), (1985 + F.col("p_partkey") % 20).cast("int")
    number = F.lpad(F.col("p_partkey").cast("string"), 7, "0")
    ref = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("see preprint hep-th/"), number)).otherwise(F.concat(author, F.lit(", "), F.col("p_name"), F.lit(" ("), year.cast("string"), F.lit(")")))
    refs = p.select(F.col("p_partkey").alias("ref_id"), ref.alias("ref_string"))
    works = p.select(F.col("p_partkey").cast("string").alias("work_id"), F.col("p_name").alias("title"), year.alias("year"))
    known = works.unionByName(p.where("p_partkey % 3 = 0").select(F.concat(F.lit("hep-th/"), number).alias("work_id"), F.lit("").alias("title"), F.lit(None).cast("int").alias("year")))
    authors = p.select(F.col("p_partkey").cast("string").alias("work_id"), author.alias("author"))
    return match.match_references(refs, known, authors, coverage=0.99)


@query("""SELECT sum(value) AS total, avg(value) AS mean, min(value) AS least, max(value) AS most, count(value) / sum(value) AS per_second FROM events""")
def timing_statistics(spark, d):
    return stats.timing_stats(table(spark, d, "events"), "value")


@query("""SELECT c_nationkey, list_sort(list(DISTINCT c_mktsegment)) AS c_mktsegment FROM customer GROUP BY 1""")
def distinct_value_sets(spark, d):
    return stats.distinct_sets(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("""
SELECT l_partkey AS ref, count(*) AS n, list_sort(list(DISTINCT l_linenumber)) AS paragraphs FROM lineitem GROUP BY 1""")
def pointer_counts(spark, d):
    items = table(spark, d, "lineitem").select(F.col("l_partkey").alias("ref"), F.col("l_linenumber").alias("paragraph"))
    return stats.pointer_counts(items, items.select("ref").distinct(), "ref", "paragraph")


@query("""
SELECT token, CAST(c_custkey AS BIGINT) AS c_custkey FROM (SELECT c_custkey, unnest(list_distinct(string_split_regex(lower(replace(c_name, ',', ' ')), '\\s+'))) AS token FROM customer) WHERE token <> ''""")
def full_text_index(spark, d):
    from citeweave.search.request import token_index

    return token_index(table(spark, d, "customer"), "c_custkey", "c_name")


@query("""
WITH x AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1), first AS (SELECT conv_id, 1 AS a, greatest(1, n // 2) AS b, n FROM x)
SELECT conv_id, CAST(p AS BIGINT) AS pos FROM first, LATERAL (SELECT unnest(range(a, b + 1)) AS p)""")
def pointer_ranges(spark, d):
    """A pointer from a conversation's first to its middle turn stands for all turns between."""
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id")
    refs = table(spark, d, "conversations").select("conv_id", F.row_number().over(w.orderBy("turn")).alias("pos"), F.count("*").over(w).alias("n"))
    named = refs.select("conv_id", "pos", F.concat(F.lit("r"), F.col("pos").cast("string")).alias("ref"))
    ends = refs.where("pos = 1").select("conv_id", F.lit(1).alias("pointer"), F.lit("r1").alias("first"), F.concat(F.lit("r"), F.greatest(F.lit(1), F.floor(F.col("n") / 2)).cast("string")).alias("last"))
    return windows.expand_ranges(ends, named, "conv_id")[0].select("conv_id", F.col("pos").cast("long").alias("pos"))


@query("""
WITH m AS (SELECT DISTINCT a.o_custkey % 200 AS source, a.o_custkey % 10 AS cite_order, l_partkey AS target FROM orders a JOIN lineitem ON l_orderkey = a.o_orderkey)
SELECT target, source, min(cite_order) AS cite_order FROM m GROUP BY 1, 2""")
def cited_by_first(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("l_orderkey") == F.col("o_orderkey"))
    found = rows.select((F.col("o_custkey") % 200).alias("source"), (F.col("o_custkey") % 10).alias("cite_order"), F.col("l_partkey").alias("target"), F.lit(1).alias("spotted"), (F.col("o_custkey") % 10).alias("lastmatch"))
    return resolve.cited_by(found).select("target", "source", F.col("lastmatch").alias("cite_order"))


@query("""
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT p_partkey FROM part) AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 25) AND l_orderkey IN (SELECT p_partkey FROM part WHERE p_size < 25)""")
def resolved_edges(spark, d):
    edges = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    return resolve.resolved_edges(edges, table(spark, d, "part").where("p_size < 25"), "l_orderkey", "l_partkey", "p_partkey")


@query("""
SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT c_mktsegment))[1:3], ', ') || CASE WHEN count(DISTINCT c_mktsegment) > 3 THEN ' et.al.' ELSE '' END AS names FROM customer GROUP BY 1""")
def display_names(spark, d):
    sets = stats.distinct_sets(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")
    return sets.select("c_nationkey", text.display_names(F.col("c_mktsegment")).alias("names"))


@query(r"""
SELECT p_partkey, split_part(p_name, ' ', 1) || ' ' || array_to_string(list_transform(string_split(p_name, ' ')[2:], lambda x: x[1] || '.'), ' ') AS short FROM part""")
def abbreviated_names(spark, d):
    parts = F.split("p_name", " ", 2)
    return table(spark, d, "part").select("p_partkey", text.abbreviated(F.concat_ws(", ", parts[0], parts[1])).alias("short"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'us:' || (1000 + p_partkey) WHEN 1 THEN 'wipo:' || p_size WHEN 2 THEN 'euro:' || p_partkey END AS patent,
  CASE p_type WHEN 'PROMO' THEN 'ConferenceProceedings' WHEN 'ECONOMY' THEN 'Book' ELSE 'Expression' END AS work_type, CASE p_type WHEN 'PROMO' THEN 'conference-proceedings' WHEN 'ECONOMY' THEN 'book' ELSE 'expression' END AS hyphenated FROM part""")
def patents_and_types(spark, d):
    key, k = F.col("p_partkey").cast("string"), F.col("p_partkey") % 4
    number = F.when(k == 0, F.concat(F.lit("US "), (F.col("p_partkey") + 1000).cast("string"))).when(k == 1, F.concat(F.lit("WO 99/"), F.col("p_size").cast("string"))).when(k == 2, F.concat(F.lit("EP "), key)).otherwise(F.lit("??"))
    kind = ids.work_type(F.when(F.col("p_type") == "PROMO", F.lit("confproc")).when(F.col("p_type") == "ECONOMY", F.lit("book")).otherwise(F.col("p_type")))
    return table(spark, d, "part").select("p_partkey", ids.patent_id(number).alias("patent"), kind.alias("work_type"), ids.hyphenated(kind).alias("hyphenated"))


@query("""
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'http://w/' || p_partkey WHEN 1 THEN 'doi/10.1234/a%20' || p_size WHEN 2 THEN 'isbn/' || p_size WHEN 3 THEN 'pmid/' || p_partkey ELSE 'work/' || sha1(CAST(p_partkey AS VARCHAR)) END AS uri,
  CASE p_partkey % 4 WHEN 0 THEN 'pmid:' || p_partkey WHEN 1 THEN 'pmc:' || p_size WHEN 2 THEN 'doi:10.1/x' ELSE 'first' END AS preferred FROM part""")
def minted_uris(spark, d):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")

    def where(n: int, k: int, c):
        return F.when(F.col("p_partkey") % n == k, c)

    uri = ids.work_uri(where(5, 0, F.concat(F.lit("http://w/"), key)), where(5, 1, F.concat(F.lit("10.1234/a "), size)), where(5, 2, size), where(5, 3, key), key)
    best = ids.preferred_id(where(4, 0, key), where(4, 1, size), where(4, 2, F.lit("10.1/x")), F.lit("first"))
    return table(spark, d, "part").select("p_partkey", uri.alias("uri"), best.alias("preferred"))


@query("""
SELECT doc_id, list_sort(list_intersect(a, b)) AS common, list_sort(list_filter(a, lambda x: NOT list_contains(b, x))) AS only_first FROM (
  SELECT doc_id, list_distinct(list_filter(string_split_regex(lower(split_part(text, chr(10), 1)), '[^a-z]+'), lambda x: x <> '')) AS a,
    list_distinct(list_filter(string_split_regex(lower(split_part(text, chr(10), 2)), '[^a-z]+'), lambda x: x <> '')) AS b FROM documents)""")
def token_set_operations(spark, d):
    lines = F.split("text", "\n")
    a, b = (F.array_distinct(text.words(F.coalesce(F.try_element_at(lines, F.lit(i)), F.lit("")))) for i in (1, 2))
    return table(spark, d, "documents").select("doc_id", F.array_sort(F.array_intersect(a, b)).alias("common"), F.array_sort(F.array_except(a, b)).alias("only_first"))


@query("""
SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0 UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT c_custkey FROM customer WHERE c_nationkey < 5""")
def set_operations(spark, d):
    c = table(spark, d, "customer")
    some = c.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")).unionByName(table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))).distinct()
    return some.exceptAll(c.where("c_nationkey < 5").select(F.col("c_custkey").alias("k")))


@query("""
SELECT event_id, user_id, CAST(round((value - lag(value) OVER w) / (event_id - lag(event_id) OVER w), 6) AS DOUBLE) AS rate FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def counter_rates(spark, d):
    return windows.rate(table(spark, d, "events").select("event_id", "user_id", "value"), "user_id", "event_id", "value").select("event_id", "user_id", F.round("rate", 6).alias("rate"))


@query("""
SELECT o_custkey, year(o_orderdate) AS y, o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderkey) - 1 AS INTEGER) AS "offset" FROM orders""")
def stacking_offsets(spark, d):
    return windows.stack_offset(table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderkey"), "o_custkey", "y", "o_orderkey")


@query("""
SELECT o_orderstatus, min(o_orderkey) AS o_orderkey FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) = 1) GROUP BY 1""")
def first_candidates(spark, d):
    return windows.first_by(table(spark, d, "orders"), "o_orderstatus", F.desc("o_totalprice"), "o_orderkey").select("o_orderstatus", "o_orderkey")


@query("""
SELECT source || ':' || lang AS canonical, doc_id, CASE source WHEN 'src0' THEN 4.0 WHEN 'src1' THEN 1.0 WHEN 'src2' THEN 4.0 ELSE 1.0 END AS weight FROM documents""")
def identifier_edge_weights(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "source", ids.canonical(F.col("source"), F.col("lang")).alias("canonical"))
    return graph.identifier_edges(rows, "doc_id", "source", "canonical", {"src0": 4.0, "src1": 1.0, "src2": 4.0})


@query("""
SELECT c_custkey AS k, coalesce(o.s, c_mktsegment) AS v FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) AS s FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o_custkey = c_custkey""")
def upsert_last(spark, d):
    current = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v"), F.lit(None).cast("struct<a:timestamp_ntz,b:bigint>").alias("o"))
    batch = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("v"), F.struct(F.col("o_orderdate").alias("a"), F.col("o_orderkey").alias("b")).alias("o"))
    known = batch.join(current.select("k"), "k", "left_semi")
    return resolve.upsert(current, known, "k", "o").select("k", "v")


@query("""
SELECT page_id, regexp_replace(trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')), '[.,\\s]+$', '') AS plain FROM pages""")
def page_texts(spark, d):
    return table(spark, d, "pages").select("page_id", text.strip_end_punctuation(text.squeeze(F.regexp_replace("html", "<[^>]*>", " "))).alias("plain"))


@query("SELECT p_partkey AS id, p_name FROM part ORDER BY p_retailprice DESC, id LIMIT 10 OFFSET 20")
def page_of_results(spark, d):
    """The third page of parts by price."""
    return windows.page(table(spark, d, "part"), [F.desc("p_retailprice"), "p_partkey"], 20, 10).select(F.col("p_partkey").alias("id"), "p_name")
