"""Incremental ingestion: files that arrive, drained in micro-batches, with Spark's own checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def file_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files: int = 1, clean: str = "off") -> DataFrame:
    """New files of a folder, so many a batch; ``clean`` = delete removes what is done."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    if clean != "off":
        reader = reader.option("cleanSource", clean)
    return reader.format(kind).load(path)


def drain(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None] | None = None, path: str | None = None) -> None:
    """Works through all that is there and stops; what a checkpoint has seen is not read again."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(batch).start() if batch else writer.format("parquet").option("path", path).outputMode("append").start()
    query.awaitTermination()


def upsert_batches(spark: SparkSession, path: str, key: str, order: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps a row a key, the last by ``order``.

    A batch is appended under its number, so that a batch that runs again replaces its
    own files; :func:`current` reads the last row of each key. A row that says it is
    deleted stays, with its flag.
    """

    def write(batch: DataFrame, number: int) -> None:
        last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
        batch.withColumn("_n", last).where("_n = 1").drop("_n").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


def current(spark: SparkSession, path: str, key: str, order: str) -> DataFrame:
    rows = spark.read.parquet(path)
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order), F.desc("batch")))
    return rows.withColumn("_n", last).where("_n = 1").drop("_n", "batch")


def windowed_counts(stream: DataFrame, time: str, delay: str, width: str, by: str) -> DataFrame:
    """Counts a window of event time; rows later than ``delay`` are dropped. An extra beside the citation operators."""
    rows = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return rows.groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def day_windows(spark: SparkSession, start: str, end: str, step: int = 1) -> DataFrame:
    """(from, to) of a harvest's steps of days, both ends included, the last cut off."""
    days = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {step} day")))
    return spark.range(1).select(days.alias("from")).withColumn("to", F.least(F.date_add("from", step - 1), F.lit(end).cast("date")))


def next_window(state: DataFrame, uri: str, default: str) -> DataFrame:
    """Where a source's next harvest starts: the day after the last one's end, else the default. state(uri, to_date, ...)."""
    last = state.where(F.col("key") == F.md5(F.lit(uri).cast("binary"))).agg(F.max("to_date").alias("to_date"))
    return last.select(F.coalesce(F.date_add("to_date", 1), F.lit(default).cast("date")).alias("start"))


def record_harvest(state: DataFrame, uri: str, start: str, end: str, n: int) -> DataFrame:
    """The state with a source's harvest noted."""
    row = state.sparkSession.createDataFrame([(uri, start, end, n)], "uri string, from_date string, to_date string, number_of_records long")
    row = row.select(F.md5(F.col("uri").cast("binary")).alias("key"), "uri", F.to_date("from_date").alias("from_date"), F.to_date("to_date").alias("to_date"), "number_of_records")
    return state.where(F.col("key") != F.md5(F.lit(uri).cast("binary"))).unionByName(row)
