"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ in at most d bits
differ in at most d bytes, so they share at least 8 - d positional bytes: the guaranteed minimum. Lists by single
bytes would hold 1/256 of the corpus each and pairs would grow with its square, so the index has a list
for every choice of 8 - d positions: two fingerprints that share m bytes meet in as many lists as there are choices
out of m. Pairs are tallied over the lists, the tally gives the bytes they share, and those that reach the
minimum are verified by their bit distance. Members of a list differ in d bytes only; in a list of more than
CROWD of them each asks for the fingerprints it is near to instead of being paired with all.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from jouleloom.llm.common import OWN, row_key, small_batches
from jouleloom.llm.components import components
from jouleloom.session import written

SEED = 42
#: Shingles whose bits are counted at once, which bounds the memory a long text needs.
BLOCK = 1 << 14


def simhash(text: str | None, size: int) -> int:
    """The fingerprint of a text as a signed long: a bit is set if more than half of the shingles set it.

    ASCII capitals count as small; words are runs without ASCII white space. A text of fewer than `size`
    words is one shingle; without a word, or null, the fingerprint is zero.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size = b" ".join(words), min(size, len(words))
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops]
    counts = np.zeros(64, np.int64)
    digest, total = xxhash.xxh64_digest, len(words) - size + 1
    for i in range(0, total, BLOCK):
        j = min(i + BLOCK, total)
        hashes = b"".join([digest(joined[s : e - 1], SEED) for s, e in zip(starts[i:j], stops[i + size - 1 : j + size - 1], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big", signed=True)


def fingerprint(text: Column, size: int) -> Column:
    @F.pandas_udf(LongType())
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([simhash(t, size) for t in texts], dtype="int64")

    return hashed.asNondeterministic()(text)


def hexadecimal(fingerprint: str) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def masks(max_bits: int) -> list[int]:
    """One signed 64-bit mask per choice of the bytes that stay in a posting."""
    out = []
    for free in combinations(range(8), max_bits):
        kept = bytes(0 if i in free else 255 for i in range(8))
        out.append(int.from_bytes(kept, "big", signed=True))
    return out


#: Members of a list up to which all of its pairs are made.
CROWD = 512


def tallied(fingerprints: DataFrame, max_bits: int, column: str = "fingerprint") -> DataFrame:
    """(a, b, lists) of the pairs a < b of distinct `fingerprints` that meet in the index, and in how many lists."""
    spark, own = fingerprints.sparkSession, F.col(column)
    at = ["choice", "bytes"]
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), own.bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks(max_bits))])
    postings = fingerprints.select(own.alias("a"), F.explode(choices).alias("posting")).select("a", "posting.*")
    # Most lists have one member; they end here. Spark takes the postings of a fingerprint for one row, and lists, whose
    # places repeat, are many times smaller in files: without a hint it may send them to all workers as small tables.
    sizes = postings.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(postings.join(sizes.hint("merge"), at), "simhash-lists")
    few = shared.where(F.col("n") <= CROWD).drop("n")
    met = few.join(few.withColumnRenamed("a", "b").hint("merge"), at).where("a < b").select("a", "b")
    many = shared.where(F.col("n") > CROWD)
    if not many.isEmpty():
        near = spark.createDataFrame([(i, m) for i, free in enumerate(combinations(range(8), max_bits)) for m in variants(free, max_bits)], "choice int, mask bigint")
        asked = many.join(near, "choice").select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("b")).where("a < b")
        met = met.union(asked.join(fingerprints.select(own.alias("b")), "b").select("a", "b"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("lists"))


def variants(free: tuple[int, ...], max_bits: int) -> list[int]:
    """Signed masks of up to `max_bits` bits within the bytes `free`."""
    places = [8 * (7 - byte) + bit for byte in free for bit in range(8)]
    some = (c for k in range(1, max_bits + 1) for c in combinations(places, k))
    return [int.from_bytes(sum(1 << p for p in c).to_bytes(8, "big"), "big", signed=True) for c in some]


def links(fingerprints: DataFrame, max_bits: int, column: str = "fingerprint") -> DataFrame:
    """(a, b, shared, distance) of all pairs a < b of the distinct `fingerprints` at `max_bits` bits or fewer."""
    least = 8 - max_bits
    # The bytes that as many lists stand for; pairs out of crowded lists may meet in fewer than all of theirs.
    shared = F.lit(0)
    for m in range(least, 8):
        shared = F.when(F.col("lists") >= comb(m, least), m).otherwise(shared)
    counted = tallied(fingerprints, max_bits, column).withColumn("shared", shared).where(F.col("shared") >= least)
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return counted.withColumn("distance", differ).where(F.col("distance") <= max_bits).select("a", "b", "shared", "distance")


def near_duplicates(df: DataFrame, size: int = 3, max_bits: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint as long, component) of every row; the component is the smallest id reachable by links.

    Equal fingerprints are one node of the graph, so copies form no pairs. Null and empty texts have the
    fingerprint zero and are linked like any other. Null ids are ignored when the smallest id is taken; a
    component of null ids only is null. Rows that repeat come out as often as they go in. An empty table
    gives an empty one. Other columns are not read.
    """
    small_batches(df.sparkSession)
    found = df.select(F.col(id_column).alias("id"), fingerprint(F.col(text), size).alias("fingerprint"))
    return _grouped(written(found, "simhash-documents"), max_bits, "id", "component")


def _grouped(rows: DataFrame, max_bits: int, smallest: str, out: str) -> DataFrame:
    """`rows`, which have a fingerprint, with the least value of `smallest` in their component."""
    distinct = written(rows.groupBy("fingerprint").agg(F.min(smallest).alias("least")), "simhash-fingerprints")
    labels = components(links(distinct, max_bits)).withColumnRenamed("node", "fingerprint")
    labelled = distinct.join(labels, "fingerprint", "left").withColumn("label", F.coalesce("label", "fingerprint"))
    labelled = written(labelled, "simhash-labels")
    first = labelled.groupBy("label").agg(F.min("least").alias(out))
    members = labelled.select("fingerprint", "label").join(first, "label").drop("label")
    return rows.join(members, "fingerprint")


def one_of_each(df: DataFrame, size: int = 3, max_bits: int = 2, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df`, all columns as they are, that stay: one of each component, that of the smallest id.

    Null ids come first. Of rows with one id the one whose other values hash lowest stays, and of rows
    that agree in everything a single one.
    """
    small_batches(df.sparkSession)
    one, two = OWN + "one", OWN + "two"
    keyed = df.withColumns({one: row_key(*df.columns, salt=1), two: row_key(*df.columns, salt=2)})
    key = F.struct(F.col(id_column).isNotNull(), F.col(id_column), one, two).alias("key")
    rows = keyed.select(fingerprint(F.col(text), size).alias("fingerprint"), one, two, key)
    rows = written(rows, "simhash-rows")
    grouped = _grouped(rows, max_bits, "key", "first")
    # Texts stay where they are unless these lists of keys are large.
    gone = written(grouped.where("NOT (key <=> first)").select(one, two).distinct(), "simhash-gone")
    twice = written(rows.groupBy(one, two).agg(F.count(F.lit(1)).alias(OWN + "n")).where(F.col(OWN + "n") > 1).select(one, two), "simhash-twice")
    stay = keyed.join(gone, [one, two], "left_anti")
    if not twice.isEmpty():
        stay = stay.join(twice, [one, two], "left_anti").union(stay.join(twice, [one, two], "left_semi").dropDuplicates([one, two]))
    return stay.drop(one, two)
