"""Archives by ranges: many tasks, broken members, very large files, resuming."""

import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from citeweave.sources import tars, xml


def archive(path, rows, mode="w"):
    with tarfile.open(path, mode) as tar:
        for name, data in rows:
            m = tarfile.TarInfo(name)
            m.size = len(data)
            tar.addfile(m, io.BytesIO(data))


ROWS = [(f"d/{i}-{'long' * 40 if i % 9 == 0 else ''}.nxml", f"<article><front/><n>{i}</n></article>".encode() * (i + 1)) for i in range(60)]


def test_ranges_are_many_tasks_and_whole(spark, tmp_path):
    archive(tmp_path / "a.tar", ROWS)
    archive(tmp_path / "b.tar.gz", ROWS[:7], "w:gz")
    (tmp_path / "empty.tar").write_bytes(b"")
    df = tars.members(spark, tars.indexed(spark, str(tmp_path), each=10_000), (".nxml",))
    assert df.rdd.getNumPartitions() > 5
    got = [(os.path.basename(r.archive), r.member, bytes(r.content)) for r in df.where("error IS NULL").collect()]
    assert sorted(got) == sorted([("a.tar", *x) for x in ROWS] + [("b.tar.gz", *x) for x in ROWS[:7]])
    assert tars.members(spark, tars.indexed(spark, str(tmp_path)), (".txt",)).where("error IS NULL").count() == 0
    parsed = xml.articles(df.withColumn("path", F.col("member")))
    assert parsed.where("error IS NULL").count() > 0


def test_a_broken_member_costs_only_itself(spark, tmp_path):
    path = tmp_path / "a.tar"
    archive(path, [("a", b"1" * 600), ("b", b"2" * 600), ("c", b"3" * 600), ("e", b"5" * 5000)])
    data = bytearray(path.read_bytes())
    places = []
    with tarfile.open(path) as tar:
        places = [m.offset for m in tar]
    data[places[1] : places[1] + 100] = b"\xff" * 100  # b's header
    path.write_bytes(bytes(data[: places[3] + 512 + 1000]))  # e is cut off
    index = tars.indexed(spark, str(tmp_path))
    got = {r.member: (bytes(r.content) if r.content is not None else None, r.error) for r in tars.members(spark, index).collect()}
    assert got["a"] == (b"1" * 600, None) and got["c"] == (b"3" * 600, None) and "b" not in got
    assert spark.read.parquet(index).agg(F.sum("errors")).first()[0] >= 1 and got["e"][0] is None and got["e"][1]


def test_more_than_two_gigabytes(spark, tmp_path):
    """A sparse archive: the members after 3 GB are read, the large one is an error."""
    path = tmp_path / "big.tar"
    with open(path, "wb") as f:
        for name, size in (("first", 10), ("huge", 3 << 30), ("last", 10)):
            m = tarfile.TarInfo(name)
            m.size = size
            f.write(m.tobuf(tarfile.GNU_FORMAT))
            if size == 10:
                f.write(b"0123456789" + bytes(502))
            else:
                f.seek(size, os.SEEK_CUR)
        f.write(bytes(1024))
    df = tars.members(spark, tars.indexed(spark, str(tmp_path)))
    got = {r.member: (r.place, r.content and bytes(r.content), r.error) for r in df.collect()}
    assert got["last"][0] > 3 << 30 and got["last"][1] == b"0123456789" and got["huge"][1] is None and "more than" in got["huge"][2]
    assert df.rdd.getNumPartitions() == 2


def test_resume_skips_finished_ranges(spark, tmp_path):
    os.mkdir(tmp_path / "in")
    archive(tmp_path / "in/a.tar", ROWS)
    index, out, seen = tars.indexed(spark, str(tmp_path / "in"), each=5000), str(tmp_path / "out"), []

    def parse(df):
        seen.append(df.select("range").distinct().count())
        if len(seen) == 3:
            raise RuntimeError("killed")
        return df.select("member", F.md5("content").alias("md5"))

    with pytest.raises(RuntimeError):
        tars.load(spark, index, out, parse, wave=2)
    ranges, before = spark.read.parquet(index).count(), len(seen)
    left = tars.load(spark, index, out, parse, wave=2)
    assert left == -(-ranges // 2) - 2 and sum(seen[before:]) == ranges - 4
    assert tars.load(spark, index, out, parse, wave=2) == 0
    rows = spark.read.parquet(f"{out}/rows")
    assert rows.count() == rows.select("member").distinct().count() == len(ROWS)


def test_written_archives_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([(n, d) for n, d in ROWS], "name string, content binary").repartition(3)
    assert tars.write(df, str(tmp_path / "x"), "name", "content").agg(F.sum("members")).first()[0] == len(ROWS)
    assert sorted(os.listdir(tmp_path / "x")) == [f"part-{i:05d}.tar" for i in range(3)]
    back = tars.members(spark, tars.indexed(spark, str(tmp_path / "x")))
    assert sorted((r.member, bytes(r.content)) for r in back.collect()) == sorted(ROWS)
