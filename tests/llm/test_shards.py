import pytest
from pyspark.sql import functions as F

from citeweave.llm import shards
from citeweave.session import scratch_path


def store_of(spark, **kw):
    return shards.ShardStore(spark, scratch_path(spark, "shards"), **{"target": 200_000, "fan_in": 3, "smallest": 8_000, **kw})


def frame(spark, lo, n):
    return spark.range(lo, lo + n, 1, 2).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))


def test_compaction_keeps_rows_and_bounds_tiers(spark):
    store = store_of(spark)
    for i in range(6):
        store.append(frame(spark, i * 300, 300))
        store.compact(frame(spark, 0, 1).schema)
    rows = store.read(frame(spark, 0, 1).schema)
    assert rows.count() == 1800 and rows.distinct().count() == 1800
    now = store.shards()
    tiers = [s["tier"] for s in now if s["bytes"] < store.target // 2]
    assert all(tiers.count(t) < store.fan_in for t in set(tiers))
    assert sum(s["rows"] for s in now) == 1800
    assert all(s["bytes"] <= 1.5 * store.target for s in now)


def test_versions_are_readable_until_vacuumed(spark):
    store = store_of(spark)
    schema = frame(spark, 0, 1).schema
    for i in range(3):
        store.append(frame(spark, i * 10, 10))
    before = store.version()
    store.compact(schema)
    assert store.read(schema, 1).count() == 10 and store.read(schema, before).count() == 30
    assert store.vacuum(keep=1) > 0 and store.read(schema).count() == 30


def test_a_version_is_committed_once(spark):
    store = store_of(spark)
    store.append(frame(spark, 0, 5))
    with pytest.raises(shards.Conflict):
        store._commit([], store.version() - 1)
    assert store.read(frame(spark, 0, 1).schema).count() == 5


def test_odd_tables(spark, odd, docs_of):
    store = store_of(spark)
    assert store.read(odd.schema).count() == 0
    store.append(docs_of([]))
    assert store.version() == 1 and store.shards() == []
    for _ in range(4):
        store.append(odd)
    store.compact(odd.schema)
    assert store.read(odd.schema).count() == 40 and store.read(odd.schema).columns == odd.columns


@pytest.mark.parametrize("kind", ["plain", "cached", "filtered", "memory", "empty", "file"])
def test_ingest_keeps_the_frames_rows(spark, docs_of, kind):
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = {
        "plain": lambda: frame(spark, 0, 700), "cached": lambda: spark.read.parquet(path).cache(), "filtered": lambda: spark.read.parquet(path).where("doc_id < 10"),
        "memory": lambda: docs_of([(1, "a"), (1, "a"), (None, None)]), "empty": lambda: docs_of([]), "file": lambda: spark.read.parquet(path),
    }[kind]()
    store = shards.ingest(docs, scratch_path(spark, "shards"))
    got = store.read(docs.schema)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))
    assert store.version() >= 1
    listed = {s["path"] for s in store.shards()}
    assert {p for f, _ in store._files(f"{store.path}/shards") for p, _ in store._files(f) if p.endswith(".parquet")} == listed
    assert not [p for p, _ in store._files(f"{store.path}/pending") if not p.endswith(".crc")]


def test_ingest_merges_more_than_one_tier(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    store = shards.ingest(docs, scratch_path(spark, "shards"))
    merged = [{s["tier"] for s in store.shards(v) if s["path"] not in {x["path"] for x in store.shards(v - 1)}} for v in range(2, store.version() + 1)]
    assert len(set().union(*merged)) >= 3  # arrivals, and what two tiers of merges make
    assert store.read(docs.schema).count() == docs.count()


def test_two_writers(spark):
    """A second writer commits and vacuums between a first one's files and its commit."""
    a = store_of(spark)
    schema = frame(spark, 0, 1).schema
    b = shards.ShardStore(spark, a.path, a.target, a.fan_in, a.smallest)
    for i in range(3):
        a.append(frame(spark, i * 10, 10))
    held = a._written(frame(spark, 100, 5))
    b.append(frame(spark, 200, 7))
    b.compact(schema)
    b.vacuum()
    a._add(held)
    assert a.read(schema).count() == 42 and a.read(schema).distinct().count() == 42


def test_a_conflict_is_tried_again(spark, monkeypatch):
    a = store_of(spark)
    schema = frame(spark, 0, 1).schema
    b = shards.ShardStore(spark, a.path, a.target, a.fan_in, a.smallest)
    commit, first = a._commit, []

    def late(new, at):
        if not first:
            first.append(1)
            b.append(frame(spark, 50, 4))
        return commit(new, at)

    monkeypatch.setattr(a, "_commit", late)
    a.append(frame(spark, 0, 5))
    assert a.version() == 2 and a.read(schema).count() == 9
    for i in range(2):
        a.append(frame(spark, 1000 * (i + 1), 3))
    first.clear()
    monkeypatch.setattr(a, "_commit", lambda new, at: (b.compact(schema), b.vacuum(), commit(new, at))[2] if not first and not first.append(1) else commit(new, at))
    a.compact(schema)  # its shards are gone when it commits
    a.vacuum(pending_seconds=0)
    assert a.read(schema).count() == 15 and sum(s["rows"] for s in a.shards()) == 15
