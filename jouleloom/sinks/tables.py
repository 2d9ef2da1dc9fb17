"""Results as tables, one partition or one table per job."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jouleloom.keys import JOB, TIME
from jouleloom.session import matching, move, new_folder, remove
from jouleloom.sinks.registry import BUCKET, WRITE, Registry, conformed, read_registry, write_registry


def write_jobs(df: DataFrame, path: str, fmt: str = "parquet", buckets: int = 0, together: bool = False) -> None:
    """Replace the written files' partitions and leave all others alone.

    A file has a folder of its own. For millions of files `buckets` puts folders of a hash of the label
    above them, so that no folder has to list them all; it must stay the same for a table. Rows arrive clustered by job.
    Within a task they are sorted by file and time, so every task
    has one open file at a time however many jobs it holds. A second write of the same jobs gives
    the same table.

    The schema of the table is written beside it and takes in what new jobs bring (see `registry.py`): each
    column has one type, and `read_jobs` gives all columns whichever batch they came with. One writer at a time.

    A folder and a file for each of very many small files take far longer than their rows. With `together` the files of
    a write share the files of its tasks, sorted as above; a write is visible as a whole or not at all, and of a label only the rows
    of its last write count. Rows replaced later stay in their folder. A table keeps to the layout that it began with.
    """
    if together and buckets:
        raise ValueError("labels that share files have no folders to put into buckets")
    spark = df.sparkSession
    if buckets:
        df = df.withColumn(BUCKET, F.pmod(F.xxhash64("file_label"), F.lit(buckets)).cast("bigint"))
    known = read_registry(spark, path)
    if known is None:
        wanted = Registry(0, fmt, buckets, (df.schema,), together)
    elif (known.fmt, known.buckets) != (fmt, buckets):
        raise ValueError(f"the table at {path} is written as {known.fmt} with {known.buckets} buckets")
    else:
        wanted = known.admitting(df.schema)
    if wanted != known:
        write_registry(spark, path, wanted)
    if wanted.together:
        return _write_together(df, path, wanted)
    (
        conformed(df, wanted.schema)
        .sortWithinPartitions(*wanted.folders, *JOB, TIME)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*wanted.folders)
        .format(fmt)
        .save(_generation(path, len(wanted.generations) - 1))
    )


def _write_together(df: DataFrame, path: str, registry: Registry) -> None:
    """One more write: made in a hidden folder, renamed when it is complete.

    The folder of its generation is what makes other readers of several writes fail, instead of giving replaced rows.
    """
    spark = df.sparkSession
    n = max(_writes(spark, path), default=-1) + 1
    making = f"{path}/_making-{uuid.uuid4().hex}"
    rows = conformed(df, registry.schema).sortWithinPartitions(*JOB, TIME).withColumn(WRITE, F.lit(n).cast("bigint"))
    try:
        rows.write.format(registry.fmt).save(f"{making}/generation={len(registry.generations) - 1}")
        move(spark, making, f"{path}/write-{n}")
    except BaseException:
        remove(spark, making)
        raise


def _writes(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the writes of a table whose labels share files."""
    return [int(name.removeprefix("write-")) for name in matching(spark, f"{path}/write-*")]


def _generation(path: str, n: int) -> str:
    """The first generation lies in the folder of the table itself."""
    return f"{path}/generation={n}" if n else path


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """A table of `write_jobs` with all columns of all batches.

    A column that changed its type begins a new generation of files beside the others, which are read as they are
    and cast. Of a label only the rows of its last generation count, or of its last write if labels share files. Other readers see the first generation
    as a plain partitioned table; once there are more, they get an error instead of a part of it.
    """
    registry = read_registry(spark, path)
    if registry is None:
        raise FileNotFoundError(f"no job table at {path}")
    if registry.together:
        return _read_together(spark, path, registry)
    parts = []
    for n, schema in enumerate(registry.generations):
        folder = _generation(path, n)
        rows = spark.read.schema(schema).format(registry.fmt).option("basePath", folder)
        try:
            parts.append((n, rows.load(f"{folder}/{registry.folders[0]}=*")))
        except AnalysisException as missing:  # a table without a row has no folder
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append((n, spark.createDataFrame([], schema)))
    wide = [conformed(df, registry.schema) for _, df in parts]
    names = [f"`{c}`" for c in registry.schema.names if c != BUCKET]
    if len(parts) == 1:
        return wide[0].select(*names)
    # Only the names of folders are read for this.
    labels = [df.select("file_label").distinct().withColumn("generation~", F.lit(n)) for n, df in parts]
    last = reduce(DataFrame.union, labels).groupBy("file_label").agg(F.max("generation~").alias("generation~"))
    every = [df.withColumn("generation~", F.lit(n)) for (n, _), df in zip(parts, wide, strict=True)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), every)
    return rows.join(last, ["file_label", "generation~"], "left_semi").select(*names)


def _read_together(spark: SparkSession, path: str, registry: Registry) -> DataFrame:
    """The rows of the last write of every label; only labels of several writes are joined, and none if there is one write."""
    parts = []
    for n, schema in enumerate(registry.generations):
        numbered = T.StructType([*schema.fields, T.StructField(WRITE, T.LongType())])
        rows = spark.read.schema(numbered).format(registry.fmt)
        try:
            parts.append(conformed(rows.load(f"{path}/write-*/generation={n}"), registry.schema, WRITE))
        except AnalysisException as missing:  # nothing was written since its schema was
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            parts.append(conformed(spark.createDataFrame([], numbered), registry.schema, WRITE))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    names = [f"`{c}`" for c in registry.schema.names]
    if len(_writes(spark, path)) < 2:
        return every.select(*names)
    of = every.groupBy(F.col("file_label").alias("label~")).agg(F.min(WRITE).alias("first~"), F.max(WRITE).alias("last~")).where("`first~` < `last~`")
    return every.join(of, every["file_label"].eqNullSafe(of["label~"]) & (every[WRITE] < of["last~"]), "left_anti").select(*names)


def write_job_jdbc(df: DataFrame, label: str, url: str, schema: str | None = None, **options: str) -> str:
    """Replace the table of one job in a database; returns its name, quoted where needed."""
    return write_jobs_jdbc(df.where(F.col("file_label") == label), [label], url, schema, **options)[0]


def write_jobs_jdbc(df: DataFrame, labels: Sequence[str], url: str, schema: str | None = None, at_once: int = 8, **options: str) -> list[str]:
    """Replace the tables of the listed jobs in a database, one table each; returns their names.

    The plan of `df` runs once: it is written by job, and every table is loaded from its job's partition, `at_once` tables
    side by side, so that the cluster is not idle between small ones and the database not flooded.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "jdbc")
    write_jobs(df.where(F.col("file_label").isin(*labels)), folder)
    written_jobs = read_jobs(spark, folder)

    def load(label: str) -> str:
        name = job_table_name(label)
        target = f'"{schema}"."{name}"' if schema else f'"{name}"'
        rows = written_jobs.where(F.col("file_label") == label).drop(*JOB)
        rows.write.format("jdbc").mode("overwrite").options(url=url, dbtable=target, **options).save()
        return name

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(load, labels))


def job_table_name(label: str) -> str:
    """What `table_name` makes of a label, without a job."""
    return "job_" + label.replace("/", "_")


def register_jobs(df: DataFrame, view: str = "jobs") -> DataFrame:
    """Make a result available to SQL."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.table(view)


def register_job_function(df: DataFrame, name: str = "job", view: str = "jobs") -> None:
    """Make the table of each job available to SQL, as `SELECT * FROM job('label')`.

    One function over one table, whatever the number of jobs. Its rows come from
    the one folder of the label, as the argument becomes a filter on it, and lack the columns that name the job.
    """
    register_jobs(df, view)
    columns = [f.name for f in df.schema if f.name not in JOB]
    typed = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    picked = ", ".join(f"`{c}`" for c in columns)
    df.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`(label STRING) RETURNS TABLE ({typed}) "
        f"RETURN SELECT {picked} FROM `{view}` WHERE `{view}`.file_label = `{name}`.label"
    )
