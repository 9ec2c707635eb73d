"""Session settings, shared scratch space and size-checked broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when a later step needs the same keys again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark's default, until a query reads placed tables (`keep_places`).
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}
# While a table is written: what was shuffled for it leaves the disks when it is there, not when the driver collects its garbage;
# and a task that writes few buckets does not sort its rows for it.
_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "8"}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by the session.

    A local session that names none gets a folder below its warehouse, which it names in any case.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/fareline/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application pinned; tables that rest on it cannot be read afterwards."""
    own = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    own.getFileSystem(spark._jsc.hadoopConfiguration()).delete(own, True)


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings for one write, taken back after it."""
    before = {key: spark.conf.get(key) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def keep_places(spark: SparkSession) -> None:
    """Let rows that are placed by a column join by it and others without a shuffle, until the next query."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def write_placed(df: DataFrame, path: str, by: str, parts: int, mode: str = "errorifexists") -> DataFrame:
    """Write `df` in buckets of `by` and read it as placed by them: grouping and joining by it needs no shuffle.

    Rows that lie by `by` in as many parts already make one file a bucket. Who reads the files by their path gets the same
    rows, without the place.
    """
    spark, name = df.sparkSession, f"placed_{uuid.uuid4().hex}"
    with writing(spark):
        df.write.mode(mode).option("path", path).option("compression", "zstd").bucketBy(parts, by).saveAsTable(name)
    placed = spark.table(name)
    # The table has done its part when its buckets are known; its files stay.
    spark.sql(f"DROP TABLE {name}")
    keep_places(spark)
    return placed


def pin(df: DataFrame, by: str | None = None, parts: int = 1) -> DataFrame:
    """Write `df` once as a table in the shared folder and go on from there.

    Cuts the lineage, survives lost executors, and lets later steps read only the columns they use. `by`: see `write_placed`.
    """
    path = new_path(df.sparkSession, "pinned")
    if by is not None:
        return write_placed(df, path, by, parts)
    with writing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000, trust_estimate: bool = True) -> DataFrame:
    """Hint a broadcast only after counting that `df` has at most `max_rows` rows.

    Beyond that the join stays a shuffle join, which adaptive execution can split on skew; without `trust_estimate` even
    where the optimizer takes `df` for small, as it does with compressed files.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df if trust_estimate else df.hint("merge")


def spread(df: DataFrame) -> DataFrame:
    """Spread an input that is read by fewer tasks than there are cores; larger ones stay as read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
