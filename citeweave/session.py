"""Sessions, table access and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("citeweave")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the cluster's ``spark.checkpoint.dir``. Only where that is unset on one machine, as
    in tests, is a temporary folder made and set; executors elsewhere couldn't see it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="citeweave-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/citeweave/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, rows: int | None = None, each: int = 50_000, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    ``rows``: about how many rows there are, where that is known; so many of ``each`` make a
    file, so that the rounds of a loop over a small table don't write hundreds of tiny files. ``compression``: other than the session's.
    """
    path = scratch_path(df.sparkSession, name)
    (df if rows is None else df.coalesce(max(1, -(-rows // each)))).write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Partitions for work that is heavy for its bytes: adaptive execution joins small ones unless their number is given."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what queries have written to the shared folder; for when their results are no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/citeweave")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
