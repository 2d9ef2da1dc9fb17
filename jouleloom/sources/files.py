"""Which containers there are, and whether they can be read."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.functions.text import file_stem, normalize_prefix
from jouleloom.session import written
from jouleloom.sources.containers import SUFFIX, file_system, probe


def discover_files(spark: SparkSession, root: str, keep_batch_files: bool = False) -> DataFrame:
    """All containers under `root`, any depth: file_label, path, length, modificationTime.

    Works for every file system Spark can list. File contents are not read. Spark's listing leaves
    out files of length zero; `containers.container_files` lists them, too, and tells what can't be read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .load(root)
        .select(file_stem(F.col("path")).alias("file_label"), "path", "length", "modificationTime")
    )
    return listing if keep_batch_files else drop_batch_files(listing)


def drop_batch_files(files: DataFrame) -> DataFrame:
    return files.where(~F.col("file_label").contains("batch"))


def object_inventory(objects: DataFrame, prefix: str = "") -> DataFrame:
    """Objects under a prefix that are containers, with their label."""
    wanted = normalize_prefix(F.lit(prefix))
    return objects.where(F.col("key").startswith(wanted) & F.col("key").endswith(SUFFIX)).withColumn(
        "file_label", file_stem(F.col("key"))
    )


def discover_union(local: DataFrame, remote: DataFrame | None) -> DataFrame:
    """(file_label, path, src_ord): local files first, then remote objects if there is a remote."""
    found = local.select("file_label", "path", F.lit(0).alias("src_ord"))
    if remote is not None:
        found = found.unionByName(
            remote.select("file_label", F.col("key").alias("path"), F.lit(1).alias("src_ord"))
        )
    return found


def require_files(files: DataFrame) -> DataFrame:
    if files.isEmpty():
        raise ValueError("no files")
    return files


def latest_per_label(files: DataFrame) -> DataFrame:
    """The file that wins its label: the last in discovery order. Give it usable files only."""
    last = F.max(F.struct("src_ord", "path")).alias("last")
    return files.groupBy("file_label").agg(last).select("file_label", "last.path", "last.src_ord")


def validate_containers(files: DataFrame) -> DataFrame:
    """Add `reason`: null if readable, else missing, empty or not_hdf5.

    The signature may stand at byte 0, 512, 1024, 2048 and so on. Executors read eight bytes at
    these places and never the whole file.
    """
    schema = files.schema.add("reason", "string")
    return files.repartition("path").mapInPandas(_probe, schema)


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(reason=[_reason(p) for p in batch["path"]])


def _reason(path: str) -> str | None:
    from pyarrow import fs

    system, name = file_system(path)
    info = system.get_file_info(name)
    return probe(system, name, info.size) if info.type == fs.FileType.File else "missing"


def readable_files(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable files, quarantine with reason)."""
    return checked.where("reason is null").drop("reason"), checked.where("reason is not null")


def files_to_process(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one readable file per label, quarantine with reason) of discovered files.

    Of several files with one label the last one in discovery order that can be read is taken.
    """
    checked = written(validate_containers(found), "checked-files")
    readable, quarantine = readable_files(checked)
    return latest_per_label(readable), quarantine
