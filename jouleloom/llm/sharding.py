"""Jump consistent hashing: stable keys to shards without a table of shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, numbered

# Fixed values of the published generator: next = key * MULTIPLIER + 1 modulo 2^64.
MULTIPLIER = "2862933555777941757"
MODULUS = "18446744073709551616"

#: Steps that one inner fold makes; a key needs ln(shards) + 1 of them on average.
STEPS = 16


def fingerprint(*columns: str) -> Column:
    """The MD5 of the values' text; a null counts as a value of its own.

    Only the values matter, not the order of rows, the number of files or the version of the engine.
    """
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns]
    return F.md5(F.concat_ws("\x1f", *parts))


def stable_key(*columns: str) -> Column:
    """The first 64 bits of the fingerprint, unsigned, as a decimal."""
    return F.conv(F.left(fingerprint(*columns), F.lit(16)), 16, 10).cast("decimal(20,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard from 0 to shards - 1 of an unsigned 64-bit key.

    The loop "jump to the next shard while below `shards`" is a fold over steps that do nothing once the
    key has landed. A key needs few steps but may need `shards` of them, so folds of STEPS steps are nested
    in a fold that hands an empty list to keys that have landed: exact for any number of shards.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")

    def step(state: Column, _: Column) -> Column:
        product = state["key"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        key = F.pmod(product, F.lit(MODULUS).cast("decimal(20,0)")).cast("decimal(20,0)")
        high = F.floor(key / F.lit(2**33).cast("decimal(10,0)")).cast("double")
        at = state["next"]
        jump = F.floor((at + 1) * (F.lit(2147483648.0) / (high + 1.0))).cast("bigint")
        landed = F.struct(key.alias("key"), at.alias("at"), jump.alias("next"))
        return F.when(at < shards, landed).otherwise(state)

    start = F.struct(key.cast("decimal(20,0)").alias("key"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("next"))
    none = F.expr("array_repeat(1, 0)")
    rounds = F.sequence(F.lit(1), F.lit(-(-shards // STEPS)))
    some = F.array_repeat(F.lit(1), STEPS)
    return F.aggregate(
        rounds,
        start,
        lambda state, _: F.aggregate(F.when(state["next"] < shards, some).otherwise(none), state, step),
        lambda state: state["at"].cast("int"),
    )


def assign_shards(df: DataFrame, keys: Sequence[str], shards: int, out: str = "shard") -> DataFrame:
    """`df` with the shard of each row. Equal keys share a shard; null keys are a key like any other.

    A column of the input named `out` is replaced. No shuffle: the shard is an expression of the key.
    """
    return df.withColumn(out, jump_hash(stable_key(*keys), shards))


def shard_slots(df: DataFrame, keys: Sequence[str], order: Sequence[str], shards: int, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """`assign_shards` plus a gapless number from 0 inside each shard, ordered by hash part, then `order`.

    No task holds a whole shard (see `numbered`). Rows that agree in `order` are interchangeable.
    """
    spread = F.conv(F.right(fingerprint(*order), F.lit(8)), 16, 10).cast("bigint")
    return numbered(assign_shards(df, keys, shards, shard), [shard], order, slot, spread=spread)


def write_shards(df: DataFrame, keys: Sequence[str], shards: int, path: str, files_per_shard: int = 8) -> None:
    """Write each shard to a folder `shard=N` of `path`; a hash of the row spreads it over several files."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_shard))
    placed = assign_shards(df, keys, shards).withColumn(OWN + "salt", salt)
    placed.repartition("shard", OWN + "salt").drop(OWN + "salt").write.partitionBy("shard").parquet(path)
