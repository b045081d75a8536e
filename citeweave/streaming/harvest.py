"""Harvests as streams whose offsets are dates, and what their batches counted.

The format ``harvest_windows`` (a Python streaming source) plans one window of days a micro-batch. Its offset is the next
day to harvest, and lies in the query's checkpoint: a run that was killed repeats its last planned window and goes on,
and a run with a later end goes on from the day after the last one. The source hands out windows, one row each; what
lies in a window is read by Spark where the window arrives.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming.listener import QueryIdleEvent, QueryProgressEvent, QueryStartedEvent, QueryTerminatedEvent, StreamingQueryListener

from citeweave.operators.windows import rate

_DAY = datetime.timedelta(days=1)


class _Windows(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.start, self.end = (datetime.date.fromisoformat(options[k]) for k in ("start", "end"))
        self.days = int(options.get("days", "1"))

    def initialOffset(self) -> dict:
        return {"day": self.start.isoformat()}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        first = datetime.date.fromisoformat(start["day"])
        if first > self.end:
            return iter(()), start
        last = min(first + (self.days - 1) * _DAY, self.end)
        return iter([(first, last)]), {"day": (last + _DAY).isoformat()}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        first, after = (datetime.date.fromisoformat(x["day"]) for x in (start, end))
        return iter([(first, after - _DAY)] if first < after else [])


class HarvestWindows(DataSource):
    """Options: start, end (days, both included), days (of a window)."""

    @classmethod
    def name(cls) -> str:
        return "harvest_windows"

    def schema(self) -> str:
        return "first date, last date"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Windows(dict(self.options))


def windows(spark: SparkSession, start: str, end: str, days: int = 1) -> DataFrame:
    """(first, last) of a harvest's windows, one a micro-batch."""
    spark.dataSource.register(HarvestWindows)
    return spark.readStream.format("harvest_windows").options(start=start, end=end, days=str(days)).load()


def harvest(spark: SparkSession, feed: Callable[[datetime.date, datetime.date], DataFrame], out: str, checkpoint: str, start: str, end: str, days: int = 1, name: str | None = None) -> None:
    """Harvests up to ``end``: a window's rows are written under the window's first day, so that a window that runs again replaces its own.

    ``feed`` gives the records of a window, both days included.
    """

    def write(batch: DataFrame, _: int) -> None:
        for w in batch.collect():  # one row
            feed(w.first, w.last).write.mode("overwrite").parquet(f"{out}/window={w.first}")

    writer = windows(spark, start, end, days).writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    query = (writer.queryName(name) if name else writer).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class Progress(StreamingQueryListener):
    """Notes what named observations of streaming queries count in each micro-batch: (query, batch, at, observation, metric, value).

    ``observed.observe("seen", F.count("*").alias("rows"))`` names an observation. Rows are kept on the driver, ``most`` at a
    time, and appended to ``path`` beyond; a batch that runs again is noted again, and :meth:`table` takes its last note.
    """

    SCHEMA = "query string, batch long, at timestamp, observation string, metric string, value double"

    def __init__(self, spark: SparkSession, path: str, most: int = 1000):
        self.spark, self.path, self.most = spark, path, most
        self.rows: list[tuple] = []

    def onQueryStarted(self, event: QueryStartedEvent) -> None:
        """Nothing is counted yet."""

    def onQueryProgress(self, event: QueryProgressEvent) -> None:
        p = event.progress
        at = datetime.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        for observation, row in p.observedMetrics.items():
            for metric, value in row.asDict().items():
                if isinstance(value, (int, float)):
                    self.rows.append((p.name or str(p.id), p.batchId, at, observation, metric, float(value)))
        if len(self.rows) >= self.most:
            self.flush()

    def onQueryIdle(self, event: QueryIdleEvent) -> None:
        """A query that waits counts nothing."""

    def onQueryTerminated(self, event: QueryTerminatedEvent) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        """All notes, and each metric's totals and change a second since the batch before."""
        self.flush()
        notes = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        last = notes.groupBy("query", "observation", "metric", "batch").agg(F.max(F.struct("at", "value")).alias("x"))
        key = F.concat_ws("/", "query", "observation", "metric")
        rows = last.select("query", "observation", "metric", "batch", "x.at", "x.value", key.alias("key"))
        from pyspark.sql import Window

        total = F.sum("value").over(Window.partitionBy("key").orderBy("batch"))  # a row a batch
        rows = rows.withColumn("total", total).withColumn("_tick", F.unix_micros("at") / 1e6)
        return rate(rows, "key", "_tick", "total").drop("key", "_tick")
