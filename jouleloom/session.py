"""Session settings the operators are designed for."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The bytes of a task, not a fixed number of tasks: shuffles are cut finely and put together up to the advisory
    # size, so that what one task holds doesn't grow with the input. Rows get many times wider and longer than they
    # are in files and shuffles, as they are aligned, described and sorted, hence less than by default.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM never compiles methods above 8000 bytes of bytecode. Wide projections grow beyond
    # that when fused; running such a stage operator by operator is many times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(name: str = "jouleloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; `extra` wins."""
    builder = SparkSession.builder.appName(name).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built; all of them can change at run time."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, named by `spark.checkpoint.dir`.

    Only a session on a single machine, as in tests, gets a folder of its own where none is named; on a
    cluster a local folder would be a different one on every machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="jouleloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


#: Where intermediates go now, if not to the folder of the application.
_CURRENT: ContextVar[str | None] = ContextVar("intermediates", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has been written to."""
    within = _CURRENT.get() or os.path.join(shared_folder(spark), spark.sparkContext.applicationId)
    return os.path.join(within, f"{name}-{uuid.uuid4().hex}")


@contextmanager
def intermediates(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for all that is written meanwhile, removed in the end: results must be complete by then.

    For what runs again and again in one application, as the batches of a stream do.
    """
    folder = new_folder(spark, name)
    token = _CURRENT.set(folder)
    try:
        yield folder
    finally:
        _CURRENT.reset(token)
        remove(spark, folder)


def _on_its_file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(context._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder on whatever file system Spark finds it."""
    system, path = _on_its_file_system(spark, folder)
    system.delete(path, True)


def move(spark: SparkSession, folder: str, to: str) -> None:
    """Give a folder a name that is not taken yet, on the same file system."""
    system, path = _on_its_file_system(spark, folder)
    if not system.rename(path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{folder} could not be moved to {to}")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The names of the folders that match a pattern, without those above them."""
    system, path = _on_its_file_system(spark, pattern)
    return [found.getPath().getName() for found in system.globStatus(path) or ()]


def exists(spark: SparkSession, folder: str) -> bool:
    system, path = _on_its_file_system(spark, folder)
    return system.exists(path)


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts lineage so that a lost executor never recomputes it, and gives Catalyst the real size in
    bytes: later joins broadcast it only if it is below `spark.sql.autoBroadcastJoinThreshold`. All that an
    application writes lies in one folder named after it, to be removed when the application has ended:
    results read it as long as they are in use.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
