"""Object listings: a user's own objects, and objects not processed yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_text(ts: Column) -> Column:
    """ISO 8601 with offset; a fraction only where there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(exact)


def user_objects(objects: DataFrame, user: Column | str) -> DataFrame:
    """Objects in the user's namespace: key, size (0 if unknown), last_modified as text."""
    name = F.lit(user) if isinstance(user, str) else user
    return objects.where(F.col("key").startswith(F.concat(name, F.lit("/")))).select(
        "key",
        F.coalesce("size", F.lit(0)).cast("bigint").alias("size"),
        iso_text(F.col("last_modified").cast("timestamp")).alias("last_modified"),
    )


def rescan_missing(inventory: DataFrame, processed: DataFrame) -> DataFrame:
    """Inventory entries whose label has no result yet."""
    return inventory.join(processed.select("file_label"), "file_label", "left_anti")
