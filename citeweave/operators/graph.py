"""Graph operators: components, ranks, traversal and degrees, as DataFrame loops."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeweave.session import materialize, tasks


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Component of every node that has an edge: ``(node, component)``, component = least node.

    Alternating large-star and small-star rounds: every round is two grouped
    minima, and the edge set never grows. The table of a round is written to the
    shared folder, so that a lost executor repeats one round and no more. Nulls
    and self-loops count as no edge.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current = materialize(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen, rows = None, current.count()
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        current = materialize(small.where("a <> b").distinct(), "edges", rows)
        state = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            break
        seen, rows = state, state[0]
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def unify(identifiers: DataFrame, record: str, scheme: str, value: str) -> DataFrame:
    """(record, group): records that share an identifier, directly or over others, are one group, named by its least record.

    An identifier's records are linked to its least one, a star: a frequent identifier
    makes as many edges as it has records. Records without identifiers are groups of
    their own. The result is the full closure, whatever the order.
    """
    rows = identifiers.where(F.col(scheme).isNotNull() & F.col(value).isNotNull()).select(F.col(record).alias("r"), scheme, value)
    # Two ends tell whether an identifier is shared; repeated rows give the same edge, and edges are made distinct later, when they are few.
    least = rows.groupBy(scheme, value).agg(F.min("r").alias("m"), F.max("r").alias("_most")).where("m < _most").drop("_most")
    groups = connected_components(rows.join(least, [scheme, value]).where("r > m").select(F.col("r").alias("src"), F.col("m").alias("dst")))
    return identifiers.select(F.col(record)).distinct().join(groups.withColumnRenamed("node", record), record, "left").select(record, F.coalesce("component", record).alias("group"))


def merge_groups(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Old groups that clusters tie together, closed over: (group, merged)."""
    return connected_components(pairs, left, right).select(F.col("node").alias("group"), F.col("component").alias("merged"))


def cite_rank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, iterations: int = 4) -> DataFrame:
    """(id, rank) after so many rounds: (1 - d) + d * the sum of citing ranks by their reference counts; all start at 1.

    nodes(id), edges(src, dst). All ranks of a round come from the round before. The
    out-degree joins once; the edges stay, and each round shuffles ranks to them.
    """
    degree = edges.groupBy("src").agg(F.count("*").alias("refs"))
    links = materialize(edges.join(degree, "src"), "links")
    ranks = nodes.select("id", F.lit(1.0).alias("rank"))
    for _ in range(iterations):
        given = links.join(ranks.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") / F.col("refs")).alias("given"))
        ranks = nodes.select("id").join(given, "id", "left").select("id", (F.lit(1 - damping) + damping * F.coalesce("given", F.lit(0.0))).alias("rank"))
        ranks = materialize(ranks, "ranks")
    return ranks


def bfs(seeds: DataFrame, edges: DataFrame, most: int | None = None) -> DataFrame:
    """(id, level) of all nodes reached from the seeds, each at its least level; cycles end. seeds(id), edges(src, dst)."""
    edges = materialize(edges.select("src", "dst").distinct(), "edges")
    reached = front = materialize(seeds.select("id").distinct().withColumn("level", F.lit(0)), "front")
    level = 0
    while (most is None or level < most) and not front.isEmpty():
        level += 1
        step = front.join(edges, front["id"] == edges["src"]).select(F.col("dst").alias("id")).distinct()
        front = materialize(step.join(reached, "id", "left_anti").withColumn("level", F.lit(level)), "front")
        reached = reached.unionByName(front)
    return reached


def drop_isolated(nodes: DataFrame, edges: DataFrame, node: str, src: str, dst: str) -> DataFrame:
    """Nodes with an edge at least."""
    ends = edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias(node)).distinct()
    return nodes.join(ends, node, "left_semi")


def neighbours(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(id, out, in): sorted neighbour lists."""
    out = edges.groupBy(F.col(src).alias("id")).agg(F.sort_array(F.collect_set(dst)).alias("out"))
    into = edges.groupBy(F.col(dst).alias("id")).agg(F.sort_array(F.collect_set(src)).alias("in"))
    return out.join(into, "id", "full")


def closure(records: DataFrame, refs: DataFrame, split_types: list[str]) -> DataFrame:
    """(root, id): what each record of a split-out type carries: linked records, on and on, up to other split-out ones.

    records(id, type), refs(src, dst).
    """
    roots = records.where(F.col("type").isin(split_types)).select(F.col("id").alias("root"), "id")
    inner = refs.join(records.where(~F.col("type").isin(split_types)).select(F.col("id").alias("dst")), "dst", "left_semi")
    inner = materialize(inner.distinct(), "refs")
    reached = front = materialize(roots, "closure")
    while not front.isEmpty():
        step = front.join(inner, front["id"] == inner["src"]).select("root", F.col("dst").alias("id")).distinct()
        front = materialize(step.join(reached, ["root", "id"], "left_anti"), "closure")
        reached = reached.unionByName(front)
    return reached


#: Pairs of a component that one task clusters by itself.
LOCAL_PAIRS = 500_000


def recluster(pairs: DataFrame, members: DataFrame, threshold: float = 0.9, local_pairs: int = LOCAL_PAIRS) -> DataFrame:
    """(group, id, cluster): a group's members within ``threshold`` of a seed along shortest paths; seeds: the least left.

    members(group, id), pairs(group, a, b, distance). A group of up to ``local_pairs`` pairs within the
    threshold is clustered in a task. No path leaves a component of these pairs, so larger groups are
    cut into components, clustered all at once: one of up to ``local_pairs`` pairs in a task, a larger
    one in rounds over all large ones. A member without such a pair is a cluster.
    """
    members = materialize(members.select("group", "id").distinct(), "members")
    near = pairs.where((F.col("distance") <= threshold) & (F.col("a") != F.col("b"))).select("group", "a", "b", "distance")
    near = materialize(near, "pairs")
    counts = near.groupBy("group").agg(F.count("*").alias("n"))
    whole = near.join(counts.where(F.col("n") <= local_pairs), "group").drop("n")
    near = near.join(counts.where(F.col("n") > local_pairs), "group").drop("n")
    node = [F.struct("group", F.col(c).alias("id")) for c in ("a", "b")]
    few = near.isEmpty()
    if not few:
        parts = connected_components(near.select(node[0].alias("src"), node[1].alias("dst"))).select(F.col("node.group").alias("group"), F.col("node.id").alias("id"), "component")
        near = near.join(parts.withColumnRenamed("id", "a"), ["group", "a"])
        sizes = near.groupBy("component").agg(F.count("*").alias("size"))
        near = materialize(near.join(sizes, "component"), "pairs")
    kind = dict(members.dtypes)
    schema = f"`group` {kind['group']}, id {kind['id']}, cluster {kind['id']}"

    def grown(rows: pd.DataFrame) -> pd.DataFrame:
        by = {}
        for a, b, d in zip(rows["a"], rows["b"], rows["distance"], strict=True):
            by.setdefault(a, []).append((b, d))
            by.setdefault(b, []).append((a, d))
        cluster = {}
        for seed in sorted(by):
            heap = [(0.0, seed)] if seed not in cluster else []
            while heap:
                d, x = heapq.heappop(heap)
                if x not in cluster:
                    cluster[x] = seed
                    for y, step in by[x]:
                        if d + step <= threshold and y not in cluster:
                            heapq.heappush(heap, (d + step, y))
        return pd.DataFrame({"group": rows["group"].iloc[0], "id": list(cluster), "cluster": list(cluster.values())})

    found = whole.repartition(tasks(whole.sparkSession), "group").groupBy("group").applyInPandas(grown, schema)
    if not few:
        found = found.unionByName(near.where(F.col("size") <= local_pairs).select("component", "group", "a", "b", "distance").groupBy("component").applyInPandas(grown, schema))
        large = _grown_in_rounds(near.where(F.col("size") > local_pairs), threshold)
        found = found if large is None else found.unionByName(large)
    found = materialize(found, "clusters")
    return members.join(found, ["group", "id"], "left").select("group", "id", F.coalesce("cluster", "id").alias("cluster"))


def _grown_in_rounds(near: DataFrame, threshold: float) -> DataFrame | None:
    """The clusters of large components; each round seeds every component's least member that is left."""
    if near.isEmpty():
        return None
    both = near.select("group", "component", F.col("a").alias("x"), F.col("b").alias("y"), "distance")
    both = materialize(both.unionByName(both.select("group", "component", F.col("y").alias("x"), F.col("x").alias("y"), "distance")), "pairs")
    left, done = materialize(both.select("group", "component", F.col("x").alias("id")).distinct(), "members"), None
    while not left.isEmpty():
        seeds = left.groupBy("group", "component").agg(F.min("id").alias("id"))
        dist = front = materialize(seeds.select("group", F.col("id").alias("seed"), "id", F.lit(0.0).alias("d")), "reach")
        while not front.isEmpty():
            step = front.withColumnRenamed("id", "x").join(both, ["group", "x"]).select("group", "seed", F.col("y").alias("id"), (F.col("d") + F.col("distance")).alias("d"))
            step = step.where(F.col("d") <= threshold).join(left, ["group", "id"], "left_semi").groupBy("group", "seed", "id").agg(F.min("d").alias("d"))
            old = dist.select("group", "id", F.col("d").alias("_d"))
            front = materialize(step.join(old, ["group", "id"], "left").where("_d IS NULL OR d < _d").drop("_d"), "reach")
            dist = materialize(dist.unionByName(front).groupBy("group", "seed", "id").agg(F.min("d").alias("d")), "reach")
        cluster = dist.select("group", "id", F.col("seed").alias("cluster"))
        done = materialize(cluster if done is None else done.unionByName(cluster), "done")
        left = materialize(left.join(cluster, ["group", "id"], "left_anti"), "members")
    return done


def resolve_emails(authorship: DataFrame, mails: DataFrame, ratio: float = 2.0) -> DataFrame:
    """(mail, name): whose address it is. authorship(paper, name), mails(paper, mail).

    A paper of one author and one address settles it. Then, in rounds, a settled
    address's other papers take its name out, and of the names left on a paper with one
    address left, the nearest by edit distance to the address's local part is taken if
    the runner-up is more than ``ratio`` times as far. Ends when a round settles nothing.
    """
    from citeweave.functions.similarity import mail_distance
    from citeweave.operators.match import best_and_second

    names, addresses = materialize(authorship.distinct(), "names"), materialize(mails.distinct(), "mails")
    single = names.groupBy("paper").agg(F.count("*").alias("n"), F.min("name").alias("name")).where("n = 1")
    alone = addresses.groupBy("paper").agg(F.count("*").alias("k"), F.min("mail").alias("mail")).where("k = 1")
    settled = materialize(single.join(alone, "paper").groupBy("mail").agg(F.min("name").alias("name")), "settled")
    while True:
        taken = addresses.join(settled, "mail").select("paper", "name")
        open_names = names.join(taken, ["paper", "name"], "left_anti")
        open_mails = addresses.join(settled, "mail", "left_anti")
        lone = open_mails.groupBy("paper").agg(F.count("*").alias("k"), F.min("mail").alias("mail")).where("k = 1").select("paper", "mail")
        scores = lone.join(open_names, "paper").select("mail", "name", mail_distance(F.substring_index("mail", "@", 1), F.col("name")).alias("score")).distinct()
        found = materialize(best_and_second(scores, "mail", "name", "score", ratio).select("mail", "name"), "settled")
        if found.isEmpty():
            return settled
        settled = materialize(settled.unionByName(found), "settled")


def topic_seeds(works: DataFrame, work: str, title: str, journal: str, pattern: str, own: str | None = None, most_title: int | None = None) -> DataFrame:
    """(id) of the works that a title's pattern names, of one journal if asked for, with titles of so many characters at most."""
    out = works.where(F.col(title).rlike(pattern))
    out = out.where(F.col(journal) == own) if own else out
    out = out.where(F.length(title) <= most_title) if most_title else out
    return out.select(F.col(work).alias("id")).distinct()


def journal_network(refs: DataFrame, journal: str, src: str, dst: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the directed network of each journal: what its works cite, and every end of that as a node."""
    edges = refs.select(journal, F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL AND dst IS NOT NULL").distinct()
    return edges.select(journal, F.explode(F.array("src", "dst")).alias("id")).distinct(), edges


def match_mails(mails: DataFrame, names: DataFrame, paper: str, mail: str, name: str, ratio: float = 1.5) -> DataFrame:
    """(mail, name, best, second): of a paper's names the one nearest to a mail's local part, if the next is ``ratio`` times as far."""
    from citeweave.functions.similarity import mail_distance
    from citeweave.operators.match import best_and_second

    pairs = mails.join(names, paper).select(F.col(mail).alias("mail"), F.col(name).alias("name"), mail_distance(F.substring_index(mail, "@", 1), F.col(name)).alias("score")).distinct()
    return best_and_second(pairs, "mail", "name", "score", ratio)


def facet_graph(hits: DataFrame, doc: str, path: str, size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Nodes (kind, id) and links (term, doc) of a hit set: top facet terms and the documents that contain them."""
    terms = hits.select(doc, F.explode(path).alias("term")).distinct()
    top = terms.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(size)
    links = terms.join(F.broadcast(top.select("term")), "term").select("term", doc)
    nodes = top.select(F.lit("term").alias("kind"), F.col("term").alias("id")).unionByName(hits.select(F.lit("doc").alias("kind"), F.col(doc).cast("string").alias("id")))
    return nodes, links


def identifier_edges(df: DataFrame, doc: str, source: str, canonical: str, weights: dict[str, float]) -> DataFrame:
    """Bipartite edges of identifiers and documents, weighted by the record's source."""
    table = F.create_map(*[F.lit(x) for p in weights.items() for x in p])
    return df.groupBy(canonical, doc).agg(F.sum(F.coalesce(F.try_element_at(table, F.col(source)), F.lit(1.0))).alias("weight"))


def laplacian_spectrum(edges: DataFrame, src: str, dst: str, most: int = 2000) -> list[float]:
    """Eigenvalues of a small graph's Laplacian, ascending; more than ``most`` nodes are refused (dense on the driver)."""
    import numpy as np

    rows = edges.select(F.least(src, dst).alias("a"), F.greatest(src, dst).alias("b")).where("a <> b").distinct()
    n = rows.select(F.explode(F.array("a", "b")).alias("x")).distinct().limit(most + 1).count()
    if n > most:
        raise ValueError(f"more than {most} nodes: the spectrum is for small graphs")
    got = rows.toArrow().to_pandas()
    nodes = {x: i for i, x in enumerate(sorted(set(got["a"]) | set(got["b"])))}
    m = np.zeros((n, n))
    a, b = got["a"].map(nodes).to_numpy(int), got["b"].map(nodes).to_numpy(int)
    m[a, b] = m[b, a] = -1
    np.fill_diagonal(m, -m.sum(1))
    return np.linalg.eigvalsh(m).tolist()
