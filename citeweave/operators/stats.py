"""Counts and distributions over works, citations and authors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def author_counts(authorship: DataFrame, author: str, limit: int | None = None) -> DataFrame:
    rows = authorship.limit(limit) if limit else authorship
    return rows.groupBy(author).agg(F.count("*").alias("n"))


def degree_counts(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str) -> DataFrame:
    """(id, n_out, n_in) of every node, zeros kept; one pass over the edges."""
    ends = edges.select(F.explode(F.array(F.struct(F.col(src).alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col(dst).alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")).select("e.*")
    counts = ends.groupBy("id").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))
    out = nodes.select(F.col(node).alias("id")).join(counts, "id", "left")
    return out.select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_out", "n_in")])


def citation_counts(works: DataFrame, citations: DataFrame, work: str, target: str) -> DataFrame:
    """(work, n) of every work, zeros kept."""
    counts = citations.groupBy(F.col(target).alias(work)).agg(F.count("*").alias("n"))
    return works.select(work).join(counts, work, "left").select(work, F.coalesce("n", F.lit(0)).alias("n"))


def joined_names(df: DataFrame, key: str, name: str, pos: str, sep: str = " and ") -> DataFrame:
    """A key's names in order of position, joined."""
    names = F.transform(F.sort_array(F.collect_list(F.struct(pos, name))), lambda x: x[name])
    return df.groupBy(key).agg(F.array_join(names, sep).alias(name))


def term_facet(df: DataFrame, path: Column, size: int = 10, order: str = "count") -> DataFrame:
    """The first ``size`` terms by count, reverse_count, term or reverse_term: (term, count)."""
    keys = {"count": [F.desc("count"), "term"], "reverse_count": ["count", "term"], "term": ["term"], "reverse_term": [F.desc("term")]}[order]
    return df.select(path.alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("count")).orderBy(*keys).limit(size)


def facet_with_other(df: DataFrame, path: Column, size: int = 10) -> DataFrame:
    """The top terms, and one row (null term) with how many fall to all others."""
    counts = df.select(path.alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("count"))
    top = counts.orderBy(F.desc("count"), "term").limit(size)
    rest = counts.select("count").unionByName(top.select((-F.col("count")).alias("count")))
    other = rest.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count")).select(F.lit(None).cast("string").alias("term"), "count")
    return top.withColumn("term", F.col("term").cast("string")).unionByName(other)


def date_histogram(df: DataFrame, date: str, interval: str, lo: str | None = None, hi: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Counts by day, month or year, over an inclusive range of dates, one series for each value of ``by``."""
    if lo is not None:
        df = df.where(F.col(date) >= F.lit(lo).cast("timestamp_ntz"))
    if hi is not None:
        df = df.where(F.col(date) <= F.lit(hi).cast("timestamp_ntz"))
    bucket = F.trunc(F.col(date).cast("date"), interval) if interval != "day" else F.col(date).cast("date")
    return df.groupBy(*(by or []), bucket.alias("bucket")).agg(F.count("*").alias("n"))


def identifier_prevalence(df: DataFrame, schemes: dict[str, Column]) -> DataFrame:
    """How many records have each set of kinds of identifier: (kinds, n); kinds sorted, comma-joined."""
    kinds = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in sorted(schemes.items())]), lambda x: x.isNotNull())
    return df.select(F.array_join(kinds, ",").alias("kinds")).groupBy("kinds").agg(F.count("*").alias("n"))


def year_matrix(df: DataFrame, citing: Column, cited: Column, lo: int, hi: int) -> DataFrame:
    """Counts by citing and cited year, both within the bounds."""
    rows = df.select(citing.alias("citing_year"), cited.alias("cited_year")).where(F.col("citing_year").between(lo, hi) & F.col("cited_year").between(lo, hi))
    return rows.groupBy("citing_year", "cited_year").agg(F.count("*").alias("n"))


def early_bucket(year: Column) -> Column:
    """``EARL`` for 1950 to 1979, the year from 1980 to 2010, else null."""
    return F.when(year.between(1950, 1979), F.lit("EARL")).when(year.between(1980, 2010), year.cast("string"))


def count_histogram(df: DataFrame, key: str, threshold: int = 287) -> DataFrame:
    """How many groups have each number of rows: (size, groups, highly)."""
    sizes = df.groupBy(key).agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("groups")).withColumn("highly", F.col("size") >= threshold)


def resolve_type(df: DataFrame, key: str, kind: str, priority: list[str]) -> DataFrame:
    """Each group's first kind by priority, with the number of its rows: (key, kind, n); null if none is listed."""
    groups = df.groupBy(key).agg(F.collect_set(kind).alias("kinds"), F.count("*").alias("n"))
    first = F.try_element_at(F.filter(F.array(*map(F.lit, priority)), lambda p: F.array_contains("kinds", p)), F.lit(1))
    return groups.select(key, first.alias(kind), "n")


def cluster_sizes(df: DataFrame, group: str) -> DataFrame:
    """(size, clusters, bar): rows without a group are of size 0; bar is the binary logarithm of the clusters."""
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("clusters"))
    none = df.where(F.col(group).isNull()).agg(F.lit(0).cast("long").alias("size"), F.count("*").alias("clusters")).where("clusters > 0")
    return sizes.unionByName(none).withColumn("bar", F.floor(F.log2("clusters") + 1).cast("long"))


def field_coverage(df: DataFrame, by: str, columns: dict[str, Column]) -> DataFrame:
    """Share of filled values of each field by group, and their mean over the fields."""
    shares = df.groupBy(by).agg(*[F.avg(F.when(c, 1.0).otherwise(0.0)).alias(k) for k, c in columns.items()])
    return shares.withColumn("mean", sum((F.col(k) for k in columns), F.lit(0.0)) / len(columns))


def topic_stats(articles: DataFrame, topics: dict[str, str], text: str, work: str, is_open: Column, cited: DataFrame, k: int = 20) -> tuple[DataFrame, DataFrame]:
    """Topics are patterns of a text. (per topic: n, n_open, n_open_cited, citations; top works: topic, rank, work, citations).

    cited(work, citations).
    """
    found = F.filter(F.array(*[F.when(F.col(text).rlike(p), F.lit(t)) for t, p in topics.items()]), lambda t: t.isNotNull())
    rows = articles.select(F.col(work), is_open.alias("_open"), F.explode(found).alias("topic")).join(cited, work, "left")
    rows = rows.withColumn("citations", F.coalesce("citations", F.lit(0)))
    stats = rows.groupBy("topic").agg(
        F.count("*").alias("n"), F.count_if("_open").alias("n_open"), F.count_if(F.col("_open") & (F.col("citations") > 0)).alias("n_open_cited"), F.sum("citations").alias("citations"),
    )
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("citations"), work))
    return stats, rows.withColumn("rank", rank).where(F.col("rank") <= k).select("topic", "rank", work, "citations")


def value_counts(df: DataFrame, column: Column, k: int = 10) -> DataFrame:
    return term_facet(df, column, k)


def top_degree(edges: DataFrame, src: str, dst: str, k: int = 5) -> DataFrame:
    """The most cited and most citing nodes: (side, rank, id, n)."""
    out = []
    for side, c in (("cited", dst), ("citing", src)):
        top = edges.groupBy(F.col(c).alias("id")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id").limit(k)
        out.append(top.select(F.lit(side).alias("side"), F.row_number().over(Window.orderBy(F.desc("n"), "id")).alias("rank"), "id", "n"))
    return out[0].unionByName(out[1])


def timing_stats(df: DataFrame, tick: str) -> DataFrame:
    """total, mean, least, most and how many a second of measured seconds."""
    return df.agg(F.sum(tick).alias("total"), F.avg(tick).alias("mean"), F.min(tick).alias("least"), F.max(tick).alias("most"), (F.count(tick) / F.sum(tick)).alias("per_second"))


def distinct_sets(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias(value))


def pointer_counts(pointers: DataFrame, refs: DataFrame, ref: str, paragraph: str) -> DataFrame:
    """Per reference how often the text points to it, and from which paragraphs in order; zeros kept."""
    counts = pointers.groupBy(ref).agg(F.count("*").alias("n"), F.sort_array(F.collect_set(paragraph)).alias("paragraphs"))
    return refs.join(counts, ref, "left").withColumns({"n": F.coalesce("n", F.lit(0)), "paragraphs": F.coalesce("paragraphs", F.array().cast("array<int>"))})


def corpus_counts(records: DataFrame, source: str, group: str) -> DataFrame:
    """Records by kind of source, and different groups."""
    return records.agg(
        F.count_if(F.col(source) == "pmc_oa").alias("open_access"), F.count_if(F.col(source) == "pmc_oa_reference").alias("references"),
        F.count_if(F.col(source) == "pubmed_api").alias("augmented"), F.count_distinct(group).alias("different"),
    )


def observed(df: DataFrame, name: str, **aggs: Column):
    """The frame with an observation that fills while it runs: (frame, Observation)."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *[c.alias(k) for k, c in aggs.items()]), seen
