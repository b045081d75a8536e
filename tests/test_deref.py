"""References followed through nested records, votes over what they lead to, and numbering."""

import pytest
from pyspark.sql import functions as F

from citeweave.operators import deref


def leaves_of(df):
    return sorted((r.id, r.field, r.path, r.value, r.is_uri) for r in df.collect())


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        ("a", None, [("x", "@b"), ("y", None)], ("@u",)), ("b", "Bee", [("z", "@c")], ("@nobody",)), ("c", "Sea", [("w", "b"), ("v", "@c"), (None, "@u")], None), ("d", None, [], None),
    ]
    return spark.createDataFrame(rows, "id string, name string, parts array<struct<n:string,`to`:string>>, at struct<ref:string>").select(
        "id", "name", F.transform("parts", lambda p: F.struct(p["n"].alias("n"), F.when(p["to"].isNotNull(), F.struct(p["to"].alias("ref"))).alias("to"))).alias("parts"), "at"
    )


def brute(all_records, uris, value, seen):
    """Leaves of a nested value, by recursion."""
    if isinstance(value, dict) and set(value) == {"ref"}:
        name = value["ref"].lstrip("@")
        if name in uris:
            return [("", uris[name], True)]
        if name in seen or name not in all_records:
            return [("", "@" + name, False)]
        value, seen = all_records[name], [*seen, name]
    if isinstance(value, dict):
        return [(f".{k}{p}", x, u) for k, v in value.items() if v is not None for p, x, u in brute(all_records, uris, v, seen)]
    if isinstance(value, list):
        return [(f".{i:06d}{p}", x, u) for i, v in enumerate(value, 1) for p, x, u in brute(all_records, uris, v, seen)]
    return [("", str(value), False)]


def test_references_are_followed_and_cycles_cut(spark, records):
    own = deref.shredded(records, "id", ["name", "parts", "at"])
    uris = spark.createDataFrame([("u", "http://u"), ("u", "http://v")], "id string, uri string")
    plain = {r["id"]: {k: v for k, v in r.items() if k != "id"} for r in (x.asDict(True) for x in records.collect())}
    want = sorted((i, f, p, x, u) for i, fields in plain.items() for f, v in fields.items() if v is not None for p, x, u in brute(plain, {"u": "http://u"}, v, [i]))
    assert leaves_of(deref.followed(own, own, uris)) == want
    assert ("a", "parts", ".000001.to.parts.000001.to.parts.000001.to", "@b", False) in want  # back to b, which is being put in
    with pytest.raises(ValueError):
        deref.followed(own, own, uris, 2)
    assert deref.followed(own.limit(0), own, uris).count() == 0


def test_merged_records(spark):
    rows = [("1", "g", "pmc_oa_reference", "T", ["a", "b"]), ("2", "g", "pmc_oa_reference", "T", ["x", "y"]), ("3", "g", "pubmed_api", "S", ["z"]), ("4", "g", "other", None, None), ("5", "h", "other", None, None)]
    df = spark.createDataFrame(rows, "id string, group string, source string, title string, author array<string>")
    values = deref.valued(deref.followed(own := deref.shredded(df, "id", ["title", "author"]), own, spark.createDataFrame([], "id string, uri string")))
    merged = deref.voted(values, df.select("id", "group", "source"), ("author",))
    got = deref.widened(merged, ["title"], ("author",)).collect()
    assert [tuple(r) for r in got] == [("g", "S", ["a", "b"])]  # 2 against 2: the lesser value; of equally long lists the least id's
    people = deref.items(merged, ("author",), ["", "name"]).orderBy("position").collect()
    assert [(r.position, r[4]) for r in people] == [(1, "a"), (2, "b")]


def test_numbers_within_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("k"), F.col("id").alias("o")).repartition(7)
    got = deref.numbered(df, "k", "o").orderBy("k", "o").collect()
    seen = {}
    for r in got:
        seen[r.k] = seen.get(r.k, 0) + 1
        assert r.n == seen[r.k]
    assert len(got) == 5000 and seen["hot"] > 3000
