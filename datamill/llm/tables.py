"""Intermediate tables in the shared folder, for operators of several passes."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from datamill.session import ensure_checkpoint_dir

# The shuffle files of a job go when it ends; nothing reads them once its table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# One word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A new path in the folder that `spark.checkpoint.dir` names; all executors see it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that operators
    with Python tasks also run where it is not installed on the executors."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="datamill-code-")
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


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
    """`df` written as Parquet to the shared folder and read back.

    It ends the lineage as a checkpoint does, but columns stay compressed and can be read
    one by one.
    """
    spark = df.sparkSession
    path = shared_folder(spark)
    with _tidy(spark):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables made by `written` that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def parts(spark: SparkSession, times: int = 1) -> int:
    """Groups to cut work into: a multiple of the session's shuffle partitions, which are
    set to the size of the data."""
    return max(1, times * int(spark.conf.get("spark.sql.shuffle.partitions")))


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once, also where lambdas inside use it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    """Words of a text (bigint); null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")
