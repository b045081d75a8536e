import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeweave.functions import similarity, tex, text
from citeweave.operators import graph


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab {}", max_size=30), st.integers(1, 3), st.integers(1, 3))
def test_braces_split_without_inventing(s, level, number):
    parsed, rest = tex.braced(s, level, number)
    assert s.endswith(rest) and set(parsed) <= set(s)
    assert not parsed or "{" in s


def test_components_are_an_equivalence(spark):
    r = random.Random(8)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)]
    parent = list(range(300))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {x.node: x.component for x in graph.connected_components(df).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}


def test_coverage_and_similarity_are_bounded(spark):
    r = random.Random(9)
    rows = [tuple(" ".join(r.choice(["the", "Dark", "halo", "x1", ""]) for _ in range(r.randint(0, 6))) for _ in range(2)) for _ in range(100)]
    df = spark.createDataFrame(rows, "a string, b string")
    out = df.select(text.token_coverage(F.col("a"), F.col("b")).alias("c"), similarity.text_similarity(F.col("a"), F.col("b")).alias("s"), similarity.text_similarity(F.col("b"), F.col("a")).alias("t")).collect()
    assert all(0 <= x.c <= 1 and 0 <= x.s <= 1 and x.s == x.t for x in out)


def test_ranks_keep_their_sum_on_a_permutation(spark):
    nodes = spark.range(20)
    edges = nodes.select(F.col("id").alias("src"), ((F.col("id") * 7 + 3) % 20).alias("dst"))
    assert abs(graph.cite_rank(nodes, edges).agg(F.sum("rank")).first()[0] - 20) < 1e-9
