"""Archives and bibliographic files as DataFrames."""

from __future__ import annotations

import csv
import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files above this size are passed over before they are read.
MOST_BYTES = 10_000_000


def binary_files(spark: SparkSession, path: str, pattern: str = "*", most_bytes: int | None = None) -> DataFrame:
    """Files with their bytes; the size test is pushed to the scan, so a large file is never opened."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return df.where(F.col("length") <= most_bytes) if most_bytes else df


def is_gzip(content: Column) -> Column:
    return F.hex(F.substring(content, 1, 2)) == "1F8B"


def tar_members(df: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(path, member, content) of each file in each archive, one at a time; a broken archive gives what came before the break."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                        for m in tar:
                            if m.isfile() and (not suffixes or m.name.endswith(suffixes)):
                                yield pd.DataFrame({"path": [path], "member": [m.name], "content": [tar.extractfile(m).read()]})
                except (tarfile.TarError, EOFError, OSError):
                    continue

    return df.select("path", "content").mapInPandas(run, "path string, member string, content binary")


def _tex_of(data: bytes) -> str:
    """TeX text of a gzip: all .tex and .bbl members of an archive, each under a banner; a plain text as it is; else empty."""
    try:
        raw = gzip.decompress(data)
    except (OSError, EOFError):
        return ""
    if raw[257:262] == b"ustar":
        parts = []
        with tarfile.open(fileobj=io.BytesIO(raw)) as tar:
            for m in tar:
                if m.isfile() and m.name.endswith((".tex", ".bbl")):
                    parts.append(f"%%% {m.name}\n" + tar.extractfile(m).read().decode("utf-8", "replace"))
        return "\n".join(parts)
    head = raw[:1024]
    if head.startswith((b"%PDF", b"\x89PNG", b"PK", b"%!PS")) or b"\0" in head:
        return ""
    return raw.decode("utf-8", "replace")


def tex_sources(df: DataFrame) -> DataFrame:
    """(path, text) of gzip files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "text": [_tex_of(x) for x in pdf["content"]]})

    return df.select("path", "content").mapInPandas(run, "path string, text string")


def pipe_lines(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Lines of fields between pipes; lines of another number of fields are passed over."""
    parts = F.split("value", r"\|")
    rows = spark.read.text(path).where(F.size(parts) == len(names))
    return rows.select(*[parts[i].alias(n) for i, n in enumerate(names)])


def email_lines(spark: SparkSession, path: str) -> DataFrame:
    """(paper, mail) of lines ``id|mail|mail...``; blanks are dropped."""
    parts = F.split("value", r"\|")
    rows = spark.read.text(path).select(parts[0].alias("paper"), F.explode(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("mail"))
    return rows.select("paper", F.trim("mail").alias("mail")).where("mail <> ''")


def json_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", "true").option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def dataset_records(datasets: DataFrame, kind: str | None = None) -> DataFrame:
    """Records of datasets ``{recordList: [...]}``, of one type if asked for."""
    rows = datasets.select(F.explode("recordList").alias("r")).select("r.*")
    return rows.where(F.col("type") == kind) if kind else rows


def id_table(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.option("sep", "|").option("header", header).csv(path)


def topic_config(spark: SparkSession, path: str, skip: int = 4) -> DataFrame:
    """(topic, pattern) from tables of which each file's first rows are a heading: terms separated by commas are alternatives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for text in pdf["value"]:
                rows = [[*map(str.strip, r), "", ""][:2] for r in list(csv.reader(io.StringIO(text)))[skip:]]
                yield pd.DataFrame([r for r in rows if all(r)], columns=["topic", "terms"])

    rows = spark.read.text(path, wholetext=True).mapInPandas(run, "topic string, terms string")
    pattern = F.array_join(F.transform(F.split("terms", ","), lambda t: F.trim(t)), "|")
    return rows.select("topic", F.concat(F.lit("(?i)"), pattern).alias("pattern"))


def changed_files(source: DataFrame, target: DataFrame) -> DataFrame:
    """What a mirror has to do: (path, action) from two listings of (path, size, md5)."""
    a, b = source.select("path", F.struct("size", "md5").alias("a")), target.select("path", F.struct("size", "md5").alias("b"))
    both = a.join(b, "path", "full")
    action = F.when(F.col("b").isNull(), "copy").when(F.col("a").isNull(), "delete").when(F.col("a") != F.col("b"), "replace")
    return both.select("path", action.alias("action")).where("action IS NOT NULL")
