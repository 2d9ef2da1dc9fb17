"""Price series landed as JSON documents: a block index and blocks of `[ms, price]` pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.operators.prices import EPOCH, PRICE, price_points

INDEX_SCHEMA = "timestamps array<bigint>"
BLOCK_SCHEMA = "series array<array<double>>, _corrupt_record string"


def seconds(ms: Column) -> Column:
    """Whole seconds, rounded down also before 1970."""
    return F.floor(ms / 1000).cast("bigint")


def price_blocks(index: DataFrame) -> DataFrame:
    """Start times of the available blocks, from documents with `timestamps` in milliseconds."""
    return index.select(F.explode("timestamps").alias("ms")).select(seconds(F.col("ms")).alias("block"))


def block_points(blocks: DataFrame) -> DataFrame:
    """Points of documents with `series`; empty pairs and pairs without a price are dropped."""
    pair = F.col("pair")
    points = blocks.select(F.explode("series").alias("pair")).where(F.size(pair) > 0)
    points = points.select(
        seconds(pair[0]).alias(EPOCH), F.try_element_at(pair, F.lit(2)).alias(PRICE)
    )
    return price_points(points)


def read_price_index(spark: SparkSession, path: str) -> DataFrame:
    return price_blocks(spark.read.schema(INDEX_SCHEMA).option("multiLine", "true").json(path))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """All readable blocks under `path`; an unreadable one is left out, not an error."""
    blocks = (
        spark.read.schema(BLOCK_SCHEMA)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )
    return block_points(blocks.where(F.col("_corrupt_record").isNull()).select("series"))
