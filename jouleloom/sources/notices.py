"""Object-store notifications: which objects to process, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.functions.text import file_stem
from jouleloom.sources.files import SUFFIX

RECORDS_SCHEMA = (
    "Records array<struct<s3:struct<bucket:struct<name:string>,object:struct<key:string>>>>"
)


def parse_notices(documents: DataFrame, text: str = "value") -> DataFrame:
    """Notification documents from a text column; other columns stay."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c != text]
    return documents.select(*rest, F.from_json(F.col(text), RECORDS_SCHEMA).alias("doc")).select(
        *rest, "doc.Records"
    )


def notice_records(notices: DataFrame, decode_keys: bool = False) -> DataFrame:
    """One row per record: its place in the document, bucket, key, file_label and `reason` (null = accepted).

    A document without records gives one row with the reason no_records.
    """
    rest = [F.col(f"`{c}`") for c in notices.columns if c != "Records"]
    rows = notices.select(*rest, F.posexplode_outer("Records").alias("place", "record"), F.size("Records").alias("n"))
    bucket, key = F.col("record.s3.bucket.name"), F.col("record.s3.object.key")
    if decode_keys:
        key = F.try_url_decode(key)
    flat = rows.select(*rest, "place", bucket.alias("bucket"), key.alias("key"), "n")
    return flat.select(
        *rest,
        "place",
        "bucket",
        "key",
        F.when(F.col("key").endswith(SUFFIX), file_stem(F.col("key"))).alias("file_label"),
        notice_reason(F.col("bucket"), F.col("key"), F.col("n")).alias("reason"),
    )


def notice_reason(bucket: Column, key: Column, records: Column) -> Column:
    blank = F.coalesce(bucket, F.lit("")).eqNullSafe("") | F.coalesce(key, F.lit("")).eqNullSafe("")
    return (
        F.when(F.coalesce(records, F.lit(0)) <= 0, "no_records")
        .when(blank, "missing_key")
        .when(~key.endswith(SUFFIX), "not_h5")
    )


def accepted(records: DataFrame) -> DataFrame:
    return records.where("reason is null").drop("reason")


def acceptance_audit(records: DataFrame) -> DataFrame:
    """How many records were accepted and rejected, by reason."""
    reason = F.coalesce("reason", F.lit("accepted")).alias("reason")
    return records.groupBy(reason).agg(F.count(F.lit(1)).alias("records"))
