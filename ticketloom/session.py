"""Session settings the operators rely on, and shared staging of tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # of repeated JSON keys the last one counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    # a listing of many paths takes so many tasks, not one for each path
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings results depend on (time zone, adaptive plans)."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder staged tables go to.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset,
    and only in local mode, a temporary folder stands in.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="ticketloom-")
    context.setCheckpointDir(root)
    return root


_RUNS: list[str] = []


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Stage into a folder of this run's own and remove it when the run ends.

    For runs that write their results: frames that read staged tables are of
    no use afterwards. Runs may be nested; the outermost one's folder goes.
    """
    if _RUNS:
        yield _RUNS[-1]
        return
    folder = f"{staging_root(spark)}/ticketloom/run-{uuid.uuid4().hex}"
    _RUNS.append(folder)
    try:
        yield folder
    finally:
        _RUNS.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_path(spark: SparkSession, name: str) -> str:
    folder = _RUNS[-1] if _RUNS else f"{staging_root(spark)}/ticketloom"
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def unstaged(frame: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    jvm, conf = frame.sparkSession._jvm, frame.sparkSession._jsc.hadoopConfiguration()
    folders = {name.rsplit("/", 1)[0] for name in frame.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a staged frame reads."""
    jvm = df.sparkSession._jvm
    conf = df.sparkSession._jsc.hadoopConfiguration()
    total = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffle files as they end, not when the driver's
    garbage is next collected. For results that are not asked for a second time."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage, survives lost executors, pins values that would differ
    on a second evaluation, and gives Catalyst the true size. Its shuffles are
    of no use once it is written.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    with shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
