"""Sharding by size-tiered compaction.

Arrivals are appended as small immutable shards. Shards of similar size are a tier;
once a tier holds enough of them they are merged into shards of the next tiers, up to
the target size, beyond which a shard rests. What the table is at any moment stands in
a versioned manifest, committed by one rename that fails if the version exists: readers
see the old table or the new one. Of two writers that commit at once one fails, and tries
again on the new manifest: an arrival is added to it, a merge is dropped if one of its
shards has gone. Files of an attempt that failed are in no manifest; ``vacuum`` deletes
them, but never those of a writer that is still at work, which a mark beside its files
tells. The rename is atomic on HDFS and the like; a store of objects needs one that
creates a key only if it is absent, or a single writer.

Nulls, texts of any length, repeated rows and columns of any name are kept as they are. An
empty arrival commits a version with nothing added. Ties in size: by path. The manifest has
one line for each shard, which compaction keeps near the table's size over the target size.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20
#: Shards of one tier that start a merge, and the size ratio of neighbouring tiers.
FAN_IN = 4
#: Bytes below which all shards are of tier 0.
SMALLEST = 64 << 10
#: Rows of an arriving shard at most.
ARRIVAL_ROWS = 20_000
#: Arrivals that a whole table is dealt into.
ARRIVALS = 16
#: Seconds after which the mark of a writer is that of one that died.
PENDING_SECONDS = 24 * 3600


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, target: int = TARGET_BYTES, fan_in: int = FAN_IN, smallest: int = SMALLEST):
        self.spark, self.path, self.target, self.fan_in, self.smallest = spark, path.rstrip("/"), target, fan_in, smallest
        self.jvm = spark._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path(path).getFileSystem(self.conf)

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _files(self, p: str) -> list[tuple[str, int]]:
        at = self._path(p)
        return [(s.getPath().toString(), s.getLen()) for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def version(self) -> int:
        """The last committed version; 0 if there is none."""
        return max((int(p.rpartition("/v")[2].removesuffix(".json")) for p, _ in self._files(f"{self.path}/manifests") if p.endswith(".json")), default=0)

    def shards(self, version: int | None = None) -> list[dict]:
        """The shards of a version: path, bytes, rows, tier."""
        version = self.version() if version is None else version
        if not version:
            return []
        stream = self.fs.open(self._path(f"{self.path}/manifests/v{version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())["shards"]
        finally:
            stream.close()

    def _commit(self, shards: list[dict], after: int) -> int:
        """Version after + 1, by a rename that never replaces a file."""
        text = json.dumps({"version": after + 1, "shards": sorted(shards, key=lambda s: s["path"])})
        draft, final = self._path(f"{self.path}/manifests/.{uuid.uuid4().hex}"), self._path(f"{self.path}/manifests/v{after + 1:08d}.json")
        out = self.fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(draft, final, none)
        except Exception as e:
            self.fs.delete(draft, False)
            if self.fs.exists(final):
                raise Conflict(f"version {after + 1} exists") from e
            raise
        return after + 1

    def tier(self, size: int) -> int:
        return max(0, math.floor(math.log(max(size, 1) / self.smallest, self.fan_in)) + 1) if size > self.smallest else 0

    def _written(self, df: DataFrame, most_rows: int = 0) -> list[dict]:
        """Writes a shard for each partition, or for each ``most_rows`` of it, and describes them.

        A mark with the folder's name keeps ``vacuum`` away until :meth:`_settle`.
        """
        name = uuid.uuid4().hex
        self.fs.create(self._path(f"{self.path}/pending/{name}")).close()
        to = f"{self.path}/shards/{name}"
        df.write.option("maxRecordsPerFile", most_rows).parquet(to)
        files = {p: n for p, n in self._files(to) if p.endswith(".parquet")}
        # Counting reads no column.
        counts = self.spark.read.schema(df.schema).parquet(to).groupBy(F.col("_metadata.file_name").alias("name")).count().collect() if files else []
        rows = {r["name"]: r["count"] for r in counts}
        made = [{"path": p, "bytes": n, "rows": rows[p.rpartition("/")[2]], "tier": self.tier(n)} for p, n in sorted(files.items()) if rows.get(p.rpartition("/")[2])]
        if not made:
            self.fs.delete(self._path(f"{self.path}/pending/{name}"), False)
        return made

    def _settle(self, shards: list[dict]) -> None:
        """Takes the marks of folders whose shards are committed or given up."""
        for name in {s["path"].rsplit("/", 2)[1] for s in shards}:
            self.fs.delete(self._path(f"{self.path}/pending/{name}"), False)

    def _publish(self, change: Callable[[list[dict]], list[dict] | None]) -> int | None:
        """Commits what ``change`` makes of the last version's shards, again and again until no other writer came first.

        None where ``change`` gives None: there is nothing left to commit.
        """
        while True:
            at = self.version()
            shards = change(self.shards(at))
            if shards is None:
                return None
            try:
                return self._commit(shards, at)
            except Conflict:
                continue

    def append(self, df: DataFrame) -> int:
        """Adds an arrival as small shards; returns the version."""
        return self._add(self._written(df, ARRIVAL_ROWS))

    def _add(self, new: list[dict]) -> int:
        at = self._publish(lambda shards: shards + new)
        self._settle(new)
        return at

    def _ready(self, shards: list[dict]) -> list[dict]:
        """The shards of the lowest tier that holds FAN_IN or more."""
        tiers: dict[int, list[dict]] = {}
        for s in sorted(shards, key=lambda s: (s["bytes"], s["path"])):
            if s["bytes"] < self.target // 2:
                tiers.setdefault(s["tier"], []).append(s)
        return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= self.fan_in), [])

    def compact(self, schema) -> int:
        """Merges tiers that hold FAN_IN shards or more until none does; one commit a merge."""
        while old := self._ready(self.shards()):
            total = sum(s["bytes"] for s in old)
            parts = max(1, min(len(old) // self.fan_in, math.ceil(total / (self.fan_in * max(s["bytes"] for s in old))))) if total < self.target else math.ceil(total / self.target)
            new = self._written(self.spark.read.schema(schema).parquet(*[s["path"] for s in old]).coalesce(parts))  # without a shuffle
            gone = {s["path"] for s in old}
            self._publish(lambda shards, gone=gone, new=new: [s for s in shards if s["path"] not in gone] + new if gone <= {s["path"] for s in shards} else None)
            self._settle(new)
        return self.version()

    def read(self, schema, version: int | None = None) -> DataFrame:
        paths = [s["path"] for s in self.shards(version)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def vacuum(self, keep: int = 1, pending_seconds: int = PENDING_SECONDS) -> int:
        """Deletes files that none of the last ``keep`` versions names; returns how many.

        Folders are listed before marks, and marks before versions: whatever has no mark any
        more is either in a version by then or given up.
        """
        inside = {folder: [p for p, _ in self._files(folder) if p.endswith(".parquet")] for folder, _ in self._files(f"{self.path}/shards")}
        marks, now = self._path(f"{self.path}/pending"), time.time()
        pending = {m.getPath().getName() for m in self.fs.listStatus(marks) if now - m.getModificationTime() / 1000 < pending_seconds} if self.fs.exists(marks) else set()
        last = self.version()
        live = {s["path"] for v in range(max(1, last - keep + 1), last + 1) for s in self.shards(v)}
        gone = 0
        for folder, files in inside.items():
            dead = [p for p in files if p not in live]
            if folder.rpartition("/")[2] in pending or not dead:
                continue
            for p in [folder] if len(dead) == len(files) else dead:
                self.fs.delete(self._path(p), True)
            gone += len(dead)
        return gone


def ingest(docs: DataFrame, path: str, arrivals: int = ARRIVALS, target: int = TARGET_BYTES) -> ShardStore:
    """Appends the frame's rows as so many arrivals, compacting and vacuuming after each.

    The rows, whatever their source, are written once, as small shards; these are then dealt
    to the arrivals. A small table's shards are so small that every arrival gets one.
    """
    store = ShardStore(docs.sparkSession, path, target)
    each = min(ARRIVAL_ROWS, max(1, -(-docs.count() // arrivals)))
    new = store._written(docs, each)
    for i in range(max(1, min(arrivals, len(new)))):
        store._publish(lambda shards, i=i: shards + new[i::arrivals])
        store.compact(docs.schema)
        store.vacuum()
    store._settle(new)
    store.vacuum()
    return store
