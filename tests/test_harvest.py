"""Harvest windows as a stream, restarts, and the notes of a listener."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from citeweave.session import tasks
from citeweave.streaming import harvest, ingest


@pytest.fixture(scope="module")
def records(spark):
    return spark.range(100).select("id", F.date_add(F.lit("2020-01-28").cast("date"), (F.col("id") % 12).cast("int")).alias("datestamp"))


def test_windows_are_batches_and_restart_repeats_one(spark, records, tmp_path):
    seen = []

    def feed(first, last):
        seen.append((first.isoformat(), last.isoformat()))
        if len(seen) == 3:
            raise RuntimeError("killed")
        return records.where(F.col("datestamp").between(first, last))

    where = dict(out=f"{tmp_path}/out", checkpoint=f"{tmp_path}/state", start="2020-01-28")
    with pytest.raises(Exception, match="killed"):
        harvest.harvest(spark, feed, end="2020-02-05", days=3, **where)
    harvest.harvest(spark, feed, end="2020-02-05", days=3, **where)
    assert seen == [("2020-01-28", "2020-01-30"), ("2020-01-31", "2020-02-02"), ("2020-02-03", "2020-02-05"), ("2020-02-03", "2020-02-05")]
    harvest.harvest(spark, feed, end="2020-02-08", days=2, **where)  # later: from the day after
    assert seen[4:] == [("2020-02-06", "2020-02-07"), ("2020-02-08", "2020-02-08")]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.id for r in got.select("id").collect()) == list(range(100)) and len(os.listdir(f"{tmp_path}/out")) == 5
    steps = [(r["from"], r["to"]) for r in ingest.day_windows(spark, "2020-01-28", "2020-02-05", 3).collect()]
    assert steps == [(datetime.date.fromisoformat(a), datetime.date.fromisoformat(b)) for a, b in seen[:3]]


def test_listener_notes_each_batch(spark, tmp_path):
    for i, n in enumerate((5, 7, 11)):
        spark.range(n).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    progress = harvest.Progress(spark, f"{tmp_path}/notes", most=2)
    spark.streams.addListener(progress)
    try:
        observed = stream.coalesce(1).observe("seen", F.count("*").alias("rows"), F.max("id").alias("top"))
        query = observed.writeStream.queryName("counted").option("checkpointLocation", f"{tmp_path}/state").format("noop").trigger(availableNow=True).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        rows = progress.table().where("metric = 'rows'").orderBy("batch").collect()
    finally:
        spark.streams.removeListener(progress)
    files = len(spark.read.parquet(*[f"{tmp_path}/in/{i}" for i in range(3)]).inputFiles())
    assert len(rows) == files and sum(r.value for r in rows) == 23 and rows[-1].total == 23
    assert rows[0].rate is None and all(r.rate is not None and r.rate >= 0 for r in rows[1:])


def test_tasks_are_at_least_the_cores(spark):
    assert tasks(spark) >= spark.sparkContext.defaultParallelism
