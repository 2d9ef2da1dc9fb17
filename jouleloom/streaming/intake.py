"""Notifications as a stream: every micro-batch rebuilds the jobs it names."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from jouleloom.operators.frames import Frames
from jouleloom.plans.files import write_build
from jouleloom.plans.jobs import build_jobs
from jouleloom.session import intermediates
from jouleloom.sources.notices import RECORDS_SCHEMA, accepted, acceptance_audit, notice_records


#: Under this name a query's progress (`observedMetrics`) tells the notices and records of its last batch.
NOTICES = "notices"
#: When a notification arrived: the time and name of its file, and its place in it.
ARRIVAL = ["arrived", "document", "place"]


def read_notices(spark: SparkSession, folder: str) -> DataFrame:
    """Notification documents arriving as JSON files, one document per file or line, and when they arrived."""
    documents = spark.readStream.schema(RECORDS_SCHEMA).json(folder)
    notices = documents.select(
        "*", F.col("_metadata.file_modification_time").alias("arrived"), F.col("_metadata.file_path").alias("document")
    )
    records = F.coalesce(F.size("Records"), F.lit(0))
    return notices.observe(NOTICES, F.count(F.lit(1)).alias("notices"), F.coalesce(F.sum(records), F.lit(0)).alias("records"))


def objects_of_batch(records: DataFrame) -> DataFrame:
    """Accepted objects of a micro-batch, one per label: of several notifications the last one counts."""
    last = F.max(F.struct(*ARRIVAL, "bucket", "key")).alias("last")
    return accepted(records).groupBy("file_label").agg(last).select("file_label", "last.bucket", "last.key")


def take_batch(batch: DataFrame, batch_id: int, out: str) -> DataFrame:
    """Write what a micro-batch holds, once, and return its accepted objects.

    Next to the records of the batch are kept its audit, its rejected records and its accepted objects,
    one folder per batch, all read from the written records.
    """
    spark = batch.sparkSession

    def keep(df: DataFrame, what: str) -> DataFrame:
        path = os.path.join(out, what, f"batch={batch_id}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    records = keep(notice_records(batch), "records")
    keep(acceptance_audit(records), "audit")
    keep(records.where("reason is not null"), "rejected")
    return keep(objects_of_batch(records), "accepted")


def stream_objects(spark: SparkSession, events_dir: str, out: str, checkpoint: str, then: Callable[[DataFrame, int], None] | None = None, **trigger) -> StreamingQuery:
    """Accept notified objects, batch by batch, and hand those of each batch and its number to `then`.

    What `then` leaves in the shared folder meanwhile is removed after each batch, as a stream has no end.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        objects = take_batch(batch, batch_id, out)
        if then is not None and not objects.isEmpty():
            with intermediates(spark, "batch"):
                then(objects, batch_id)

    query = read_notices(spark, events_dir).writeStream.option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).foreachBatch(take).start()


def stream_jobs(
    spark: SparkSession,
    events_dir: str,
    out: str,
    checkpoint: str,
    load: Callable[[DataFrame], Frames],
    prices: DataFrame | None = None,
    **trigger,
) -> StreamingQuery:
    """Build and replace the table rows of every notified object.

    `load` turns a batch of (file_label, bucket, key) into frames. The checkpoint makes delivery
    at least once; replacing all rows of a label makes repeating a batch harmless, and a label notified
    again in a later batch is replaced by what was notified last. Batches may bring other datasets: read the tables
    by `read_jobs`. Next to them, `counts` has rows and columns written and files set aside of every batch, observed while
    they are written, and `quarantine` those files with the reason.
    """

    def build(objects: DataFrame, batch_id: int) -> None:
        made = build_jobs(load(objects), prices)
        told = write_build(made, os.path.join(out, "jobs"))
        set_aside = Observation("quarantine")
        kept = made.quarantine.observe(set_aside, F.count(F.lit(1)).alias("files"))
        kept.write.mode("overwrite").parquet(os.path.join(out, "quarantine", f"batch={batch_id}"))
        one = spark.createDataFrame([(told["rows"], told["columns"], set_aside.get["files"])], "rows bigint, columns bigint, quarantined bigint")
        one.coalesce(1).write.mode("overwrite").parquet(os.path.join(out, "counts", f"batch={batch_id}"))

    return stream_objects(spark, events_dir, out, checkpoint, build, **trigger)
