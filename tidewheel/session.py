"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: With this setting a query's shuffle files go when it has ended, not when the driver collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STAGING = "tidewheel.staging.dir"


def local_session(cores: str = "8", app: str = "tidewheel", shared: str | None = None) -> SparkSession:
    """Session for tests and the bench, which name a folder for staged tables; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if shared:
        spark.conf.set(_STAGING, shared)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def staging_root(spark: SparkSession) -> str:
    """The session's own folder below the one that ``spark.checkpoint.dir`` names, which all executors share.

    Where that is not set, ``tidewheel.staging.dir`` names it (tests); without either nothing can be staged. The
    folder is deleted when the driver's JVM ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get(_STAGING, None)
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = f"{named.rstrip('/')}/tidewheel/{spark.sparkContext.applicationId}"
    if spark.conf.get("tidewheel.staging.made", None) != root:
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        spark.conf.set("tidewheel.staging.made", root)
    return root


def staging_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the staging folder."""
    return f"{staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that end inside leave no shuffle files behind, so a chain of staged tables never holds them all."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read, never a second evaluation, so columns
    such as a partition number stay what they were when the table was written.
    """
    path = staging_path(df.sparkSession, label)
    with brief_shuffles(df.sparkSession):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing unwritten depends on any more; otherwise they stay until the session ends."""
    for df in staged:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
