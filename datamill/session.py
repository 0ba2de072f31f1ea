"""Session settings, checkpoints and short-lived caching."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "datamill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew-join splitting and Arrow switched on.

    `master` stays unset on a cluster, where spark-submit names it.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed join side even when that costs one more shuffle later on.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder named by `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder; on a cluster the executors
    could not see it, so a missing setting is an error there.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="datamill-checkpoint-")
    context.setCheckpointDir(folder)


def new_folder(spark: SparkSession) -> str:
    """A path not used yet in the folder that `spark.checkpoint.dir` names."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the reliable checkpoint folder and go on from the written copy.

    Loops use it once per round: plans stay short and a lost executor costs a re-read, not
    a replay. It also fixes values that two branches of one plan must see alike.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# The shuffle files of a job go when it ends; nothing reads them once its table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """`df` as compressed columns in the reliable checkpoint folder, and read from there.

    It ends the lineage as `cut` does in a third of the space, and the shuffle files of the job
    go with its end. Rows come back in any order. The files stay until `discard`.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    with _tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def cut_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, Any]]:
    """`written`, and aggregates of the rows taken by the very job that writes them.

    A task that runs again may be counted again, so a metric tells whether rows are there and
    whether two writes differ, and steers work; it never becomes a result.
    """
    seen = Observation()
    table = written(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]))
    return table, seen.get


def discard(*tables: DataFrame) -> None:
    """Delete what `written` made and nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that operators
    with Python tasks also run where it is not installed on the executors."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="datamill-code-")
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


@contextmanager
def persisted(*frames: DataFrame) -> Iterator[tuple[DataFrame, ...]]:
    """Keep frames in memory, spilling to disk, while the block uses them repeatedly."""
    kept = tuple(df.persist(StorageLevel.MEMORY_AND_DISK) for df in frames)
    try:
        yield kept
    finally:
        for df in kept:
            df.unpersist()


def use_all_cores(scan: DataFrame) -> DataFrame:
    """Spread a file scan over all cores when its files give work to fewer than half.

    For costly per-row work on few row groups. A large table has far more parts than there
    are cores and is left as it is, without a shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 <= cores else scan
