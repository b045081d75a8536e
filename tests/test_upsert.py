"""Upserts by state against the batch answer after every batch."""

import random

from pyspark.sql import functions as F

from citeweave.streaming import upsert


def test_visible_rows_after_every_batch(spark, tmp_path):
    r = random.Random(3)
    schema = "id string, place long, name string, deleted boolean"
    batches = [[(f"k{r.randrange(12)}", r.randrange(100) * 10 + i, f"n{i}", r.random() < 0.25) for _ in range(15)] for i in range(5)]
    typed = spark.createDataFrame([], schema).schema
    table = upsert.Table(spark, f"{tmp_path}/table", "id", typed, every=2)
    seen = []

    def check(batch, number):
        table.write(batch, number)
        seen.append(sorted((x.id, x.place) for x in table.visible().collect()))

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        stream = spark.readStream.schema(typed).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        query = upsert.newest(stream, "id", "place").writeStream.option("checkpointLocation", f"{tmp_path}/state").outputMode("update").foreachBatch(check).trigger(availableNow=True).start()
        query.awaitTermination()
        best = {}
        for b in batches[: i + 1]:
            for x in b:
                if x[0] not in best or x[1] >= best[x[0]][1]:
                    best[x[0]] = x
        assert seen[-1] == sorted((k, x[1]) for k, x in best.items() if not x[3])
    assert table._manifest()[0] >= 2
    before = table.visible().collect()
    table.write(spark.createDataFrame([("k0", 10_000, "again", False)], schema).where(F.lit(False)), 0)  # an old batch again
    assert sorted(table.visible().collect()) == sorted(before)
