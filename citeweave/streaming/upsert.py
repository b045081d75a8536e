"""Upserts by state: the newest row of each key is known to the stream, and the table is never read as a whole for a batch.

State is keyed by the canonical id and holds the order of the row that counts. A row that is older than what its key has
goes no further, whenever it comes. What goes on is appended as a delta under the batch's number; a deletion is a row
with its flag. After ``every`` deltas they are merged with the base into a new one, and deleted keys go. A base is
named by its version and last batch, and counts once Spark has committed it: readers read a whole base and ``every``
deltas at most. A batch that runs again replaces its own delta.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Newest(StatefulProcessor):
    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "place long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in rows:  # a batch of the key's rows at a time
            top = pdf.sort_values(self.order, kind="stable").tail(1)
            if best is None or top[self.order].iloc[0] >= best[self.order].iloc[0]:
                best = top
        if best is None:
            return
        place = int(best[self.order].iloc[0])
        if not self.last.exists() or place >= self.last.get()[0]:
            self.last.update((place,))
            yield best

    def close(self) -> None:
        """Nothing is held beside the state."""


def newest(stream: DataFrame, key: str, order: str) -> DataFrame:
    """Of a batch's rows those that are the newest of their key so far, by ``order``, a whole number; the rest go."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    return stream.groupBy(key).transformWithStateInPandas(_Newest(order), stream.schema, "Update", "None")


class Table:
    """A table of the newest rows in a shared folder: base, deltas and the manifest that names them."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, deleted: str = "deleted", every: int = 10):
        self.spark, self.path, self.key, self.schema, self.deleted, self.every = spark, path, key, schema, deleted, every

    def _manifest(self) -> tuple[int, int]:
        """(version of the base, last batch in it)."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        found = [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []
        named = [tuple(map(int, n.removeprefix("base-").split("-"))) for n in found if n.startswith("base-") and files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return max(named, default=(0, -1))

    def _rows(self, upto: int | None = None) -> tuple[DataFrame, int, int, int]:
        version, last = self._manifest()
        rows = self.spark.createDataFrame([], self.schema).withColumn("_batch", F.lit(-1).cast("long"))
        if version:
            rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/base-{version:06d}-{last}").withColumn("_batch", F.lit(-1).cast("long"))
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/delta")
        files = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        numbers = [int(s.getPath().getName().removeprefix("batch=")) for s in files.listStatus(place)] if files.exists(place) else []
        numbers = sorted(n for n in numbers if n > last and (upto is None or n <= upto))
        for n in numbers:
            rows = rows.unionByName(self.spark.read.schema(self.schema).parquet(f"{self.path}/delta/batch={n}").withColumn("_batch", F.lit(n).cast("long")))
        newest = rows.groupBy(self.key).agg(F.max_by(F.struct(*self.schema.names), "_batch").alias("x")).select("x.*")
        return newest, version, len(numbers), max(numbers, default=last)

    def visible(self) -> DataFrame:
        """The rows that stand now; a key that was deleted last has none."""
        return self._rows()[0].where(~F.coalesce(self.deleted, F.lit(False)))

    def write(self, batch: DataFrame, number: int) -> None:
        """Takes a batch of :func:`newest` rows; for ``foreachBatch``."""
        if number <= self._manifest()[1]:
            return  # it is in the base already
        batch.write.mode("overwrite").parquet(f"{self.path}/delta/batch={number}")
        rows, version, deltas, last = self._rows(number)
        if deltas >= self.every:
            # The base's name is its manifest entry: it counts once its _SUCCESS is there.
            rows.where(~F.coalesce(self.deleted, F.lit(False))).write.mode("overwrite").parquet(f"{self.path}/base-{version + 1:06d}-{last}")
