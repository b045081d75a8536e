"""Archives of any size, read in ranges of their members by many tasks.

A first pass walks each archive's headers, without its contents, and writes an index: ranges of whole members of about
``RANGE`` bytes. The format ``tar_ranges`` (a Python data source) has a partition for each range of an index; a task opens
the archive at its members' places. So a 100 GB archive is as many tasks as it has ranges, no archive is a cell of a
table, and a member that can't be read costs only itself: it is a row with an error and no content.

Archives are opened by Arrow's file systems (local or shared folders, hdfs, s3, gs), by the address that Spark gives.
A compressed archive can't be entered in the middle: it is one range, read as a stream, member by member.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from citeweave.session import materialize, tasks

#: Bytes of a range, and of a member at most: a cell holds no more.
RANGE, MOST_MEMBER = 64 << 20, 1 << 30
#: Bytes of contents that leave a task at once.
BATCH = 16 << 20
SCHEMA = "archive string, range int, place long, member string, content binary, error string"
_INDEX = "archive string, range int, places array<long>, bytes long, errors int"


def _opened(address: str):
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(address) if ":" in address else (fs.LocalFileSystem(), address)
    return files.open_input_file(path)


def _ranges(address: str, each: int) -> Iterator[tuple[str, int, list[int], int, int]]:
    """The ranges of one archive; a place before which headers couldn't be read counts as an error of its range."""
    with _opened(address) as f:
        head = f.read(6)
        if head[:2] == b"\x1f\x8b" or head[:3] == b"BZh" or head == b"\xfd7zXZ\0":
            yield address, 0, [-1], 0, 0
            return
        f.seek(0)
        number, places, size, errors, end = 0, [], 0, 0, 0
        try:
            tar = tarfile.TarFile(fileobj=f, ignore_zeros=True)
            while (m := tar.next()) is not None:
                tar.members = []  # headers are not kept
                errors += m.offset > end
                end = m.offset_data + -(-m.size // tarfile.BLOCKSIZE) * tarfile.BLOCKSIZE
                if m.isfile():
                    places.append(m.offset)
                    size += m.size
                if size >= each or len(places) >= 100_000:
                    yield address, number, places, size, errors
                    number, places, size, errors = number + 1, [], 0, 0
        except (tarfile.TarError, OSError, EOFError):
            errors += 1
        if places or errors:
            yield address, number, places, size, errors


def indexed(spark: SparkSession, path: str, pattern: str = "*.tar*", each: int = RANGE) -> str:
    """Walks the headers of the archives of a folder, an archive a task, and writes their index; its place is returned."""
    from citeweave.session import scratch_path

    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for address in batch.column("path").to_pylist():
                for row in _ranges(address, each):
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.string(), pa.int32(), pa.list_(pa.int64()), pa.int64(), pa.int32()), strict=True)], names=["archive", "range", "places", "bytes", "errors"])

    out = scratch_path(spark, "archives")
    found.repartition(tasks(spark), "path").mapInArrow(run, _INDEX).write.parquet(out)
    return out


class _Range(InputPartition):
    def __init__(self, archive: str, number: int, places: list[int]):
        super().__init__((archive, number))
        self.archive, self.number, self.places = archive, number, places


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[_Range]:
        import pyarrow.dataset as ds
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(self.options["path"]) if ":" in self.options["path"] else (fs.LocalFileSystem(), self.options["path"])
        rows = ds.dataset(path, filesystem=files, format="parquet").to_table(columns=["archive", "range", "places"]).to_pylist()
        return [_Range(r["archive"], r["range"], r["places"]) for r in rows]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        suffixes = tuple(filter(None, self.options.get("suffixes", "").split(",")))
        rows: list[tuple] = []
        held = 0
        for place, member, content, error in _members(part.archive, part.places, suffixes):
            rows.append((part.archive, part.number, place, member, content, error))
            held += len(content or b"")
            if held >= BATCH:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["archive", "range", "place", "member", "content", "error"])


def _content(tar: tarfile.TarFile, m: tarfile.TarInfo) -> tuple[bytes | None, str | None]:
    if m.size > MOST_MEMBER:
        return None, f"{m.size} bytes are more than a cell holds"
    try:
        data = tar.extractfile(m).read()
    except (tarfile.TarError, EOFError, OSError) as e:
        return None, str(e)[:200] or "unreadable"
    return (data, None) if len(data) == m.size else (None, "the archive ends within the member")


def _members(address: str, places: list[int], suffixes: tuple[str, ...]) -> Iterator[tuple]:
    """(place, name, content, error) of the members at these places of an archive, or of all members of a compressed one."""
    with _opened(address) as f:
        if places == [-1]:
            try:
                with tarfile.open(fileobj=f, mode="r|*") as tar:
                    for m in tar:
                        if m.isfile() and (not suffixes or m.name.endswith(suffixes)):
                            yield (m.offset, m.name, *_content(tar, m))
            except (tarfile.TarError, EOFError, OSError) as e:
                yield None, None, None, str(e)[:200] or "unreadable"
            return
        for place in places:
            try:
                f.seek(place)
                tar = tarfile.TarFile(fileobj=f)
                m = tar.next() if not tar.members else tar.members[0]
                if not suffixes or m.name.endswith(suffixes):
                    yield (place, m.name, *_content(tar, m))
            except (tarfile.TarError, EOFError, OSError, AttributeError) as e:
                yield place, None, None, str(e)[:200] or "unreadable"


class TarRanges(DataSource):
    """``spark.read.format("tar_ranges").option("suffixes", ".xml,.nxml").load(index)``."""

    @classmethod
    def name(cls) -> str:
        return "tar_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def members(spark: SparkSession, index: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(archive, range, place, member, content, error) of the files in an index's ranges."""
    spark.dataSource.register(TarRanges)
    return spark.read.format("tar_ranges").option("suffixes", ",".join(suffixes)).load(index)


def load(spark: SparkSession, index: str, out: str, parse: Callable[[DataFrame], DataFrame], suffixes: tuple[str, ...] = (), wave: int = 1000) -> int:
    """Parses an index's ranges into ``out``, ``wave`` of them at a time, and returns how many were left to do.

    A wave's rows and its list of ranges are committed by one write each, rows first under the wave's own name, so that a
    run after a failure goes on with the wave that failed, replaces what it left, and skips finished ranges. ``parse``
    keeps the columns that it wants of :func:`members`' rows.
    """
    ranges = spark.read.parquet(index)
    numbered = ranges.select("archive", "range").distinct().orderBy("archive", "range")
    keys = materialize(numbered.withColumn("wave", F.floor((F.row_number().over(_whole_order()) - 1) / wave).cast("int")), "waves")
    done = {r.wave for r in spark.read.schema("wave int").parquet(f"{out}/finished").collect()} if _exists(spark, f"{out}/finished") else set()
    todo = sorted({r.wave for r in keys.select("wave").distinct().collect()} - done)
    for number in todo:
        mine = materialize(ranges.join(keys.where(F.col("wave") == number), ["archive", "range"], "left_semi"), "wave")
        part = mine.inputFiles()[0].rsplit("/", 1)[0] if mine.inputFiles() else None
        if part:
            parse(members(spark, part, suffixes)).write.mode("overwrite").parquet(f"{out}/rows/wave={number}")
        spark.createDataFrame([(number,)], "wave int").coalesce(1).write.mode("append").parquet(f"{out}/finished")
    return len(todo)


def _whole_order():
    from pyspark.sql import Window

    return Window.orderBy("archive", "range")  # ranges only: one small row for 64 MB


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def write(df: DataFrame, path: str, name: str, content: str) -> DataFrame:
    """Writes (name, content) rows as archives in a folder, one for each task: (archive, members, bytes).

    An archive is written under a name of its attempt and then renamed to its task's, so that a task that runs again or
    twice leaves one whole archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        files, folder = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        files.create_dir(folder)
        final, own = f"{folder}/part-{task.partitionId():05d}.tar", f"{folder}/.part-{task.partitionId():05d}-{task.taskAttemptId()}"
        n = 0
        with files.open_output_stream(own) as f, tarfile.open(fileobj=f, mode="w|") as tar:
            for batch in batches:
                for key, data in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                    data = data.as_py() or b""
                    m = tarfile.TarInfo(key)
                    m.size = len(data)
                    tar.addfile(m, io.BytesIO(data))
                    n += 1
        size = files.get_file_info(own).size
        files.move(own, final)
        yield pa.RecordBatch.from_pydict({"archive": [final], "members": [n], "bytes": [size]})

    rows = df.select(F.col(name).cast("string").alias("name"), F.col(content).cast("binary").alias("content"))
    return rows.mapInArrow(run, "archive string, members long, bytes long")
