"""Importance resampling towards a target: hashed word n-grams, bucket gains, Gumbel top-k.

A feature's bucket is the CRC-32 of its bytes. A CRC is linear over XOR: each byte adds a value that depends
on the byte and on its distance from the end, and the length adds a constant. So all features of a block of
text are hashed together: the values are looked up in a table by position, and `bitwise_xor.reduceat` joins
them over the spans of the features, which overlap. Spans longer than the table are folded block by block.

Documents are read twice, once for the corpus' buckets and once for the weights; in between only the counts
of the buckets, whose number is a parameter, come to the driver.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, numbered, small_batches
from jouleloom.session import written

#: Distances from the end that the table covers.
WIDTH = 256
#: Bytes of text whose features are hashed at once, which bounds the memory a long text needs.
BLOCK = 1 << 17

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def position_table(width: int = WIDTH) -> np.ndarray:
    """What a byte adds to the CRC register, by its distance from the end (row) and its value (column)."""
    last = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        last = (last >> np.uint32(1)) ^ np.where(last & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    rows = [last]
    for _ in range(width - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ last[rows[-1] & np.uint32(255)])
    return np.stack(rows)


TABLE = position_table()
#: The CRC of as many zero bytes: what the length alone adds.
LENGTHS = np.array([zlib.crc32(bytes(n)) for n in range(WIDTH + 1)], np.uint32)


def _joined(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The XOR of the table's values over spans of 1 to WIDTH bytes."""
    firsts = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(firsts, sizes)
    index = (np.repeat(sizes - 1, sizes) - within) * 256
    index += data[np.repeat(starts, sizes) + within]
    return np.bitwise_xor.reduceat(TABLE.ravel()[index], firsts)


def span_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The CRC-32 of every span of `data` (bytes); spans have at least one byte and may overlap."""
    out = np.zeros(len(starts), np.uint32)
    short = sizes <= WIDTH
    if short.any():
        out[short] = _joined(data, starts[short], sizes[short]) ^ LENGTHS[sizes[short]]
    if not short.all():
        out[~short] = _folded(data, starts[~short], sizes[~short])
    return out


def _folded(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Long spans, a first part of up to WIDTH bytes and then block by block, all spans together.

    The register before a block acts as if XORed into the block's first four bytes.
    """
    begin = (sizes - 1) % WIDTH + 1
    register = _joined(data, starts, begin) ^ LENGTHS[begin] ^ ONES
    at, left, open_ = starts + begin, sizes - begin, np.arange(len(starts))
    step = max(BLOCK // WIDTH, 1)
    while len(open_):
        for i in range(0, len(open_), step):
            some = open_[i : i + step]
            old = register[some]
            new = _joined(data, at[some], np.full(len(some), WIDTH))
            for k in range(4):
                new ^= TABLE[WIDTH - 1 - k, (old >> np.uint32(8 * k)) & np.uint32(255)]
            register[some] = new
        at[open_] += WIDTH
        left[open_] -= WIDTH
        open_ = open_[left[open_] > 0]
    return register ^ ONES


#: Bytes to words: ASCII capitals become small, other ASCII than letters and digits separates.
FOLD = bytes((b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32) for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; capitals A-Z as small letters."""
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def blocks(texts: list[list[bytes]], size: int) -> Iterator[tuple[list[list[bytes]], list[int], list[int]]]:
    """Runs of words of about BLOCK bytes: (words, text, how many of them lead a feature) of every run.

    A text may go on in the next block; `size - 1` words more are then given to complete features.
    """
    runs, owners, leads, held = [], [], [], 0
    for t, of in enumerate(texts):
        at = 0
        while at < len(of):
            end = at
            while end < len(of) and held < BLOCK:
                held += len(of[end]) + 1
                end += 1
            runs.append(of[at : end + size - 1])
            owners.append(t)
            leads.append(end - at)
            at = end
            if held >= BLOCK:
                yield runs, owners, leads
                runs, owners, leads, held = [], [], [], 0
    if runs:
        yield runs, owners, leads


def feature_buckets(texts: list[list[bytes]], size: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all runs of 1 to `size` consecutive words, block by block."""
    for runs, owners, leads in blocks(texts, size):
        data = np.frombuffer(b" ".join(w for r in runs for w in r), np.uint8)
        sizes = np.array([len(w) for r in runs for w in r], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        ends = starts + sizes
        counts = np.array([len(r) for r in runs])
        run = np.repeat(np.arange(len(runs)), counts)
        place = np.arange(len(sizes)) - np.repeat(np.cumsum(counts) - counts, counts)
        leading = place < np.array(leads)[run]
        for k in range(size):
            first = np.flatnonzero(leading & (place + k < counts[run]))
            if len(first):
                crcs = span_crcs(data, starts[first], ends[first + k] - starts[first])
                yield np.array(owners)[run[first]], (crcs % np.uint32(buckets)).astype(np.int64)


def bucket_counts(df: DataFrame, text: str, size: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket; each task sends its counts, not its features."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, found in feature_buckets([words(t) for t in b["text"]], size, buckets):
                total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    counted = df.select(F.col(text).alias("text")).mapInPandas(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in counted.collect():  # one row a bucket
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For every bucket the logarithm of how much more frequent it is in the target, in thousandths, floored."""
    of_source, of_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratio = ((t + 1.0) * of_source / ((s + 1.0) * of_target) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighted(df: DataFrame, gain: np.ndarray, size: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_words, n_features and weight: the floored mean gain of a text's features, 0 without any."""
    buckets = len(gain)

    @F.pandas_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            cut = [words(t) for t in texts]
            times, total = np.zeros(len(cut), np.int64), np.zeros(len(cut), np.int64)
            for owner, bucket in feature_buckets(cut, size, buckets):
                np.add.at(times, owner, 1)
                np.add.at(total, owner, gain[bucket])
            yield pd.DataFrame({"n_words": [len(c) for c in cut], "n_features": times, "weight": total // np.maximum(times, 1)})

    found = df.select(*keep, weigh.asNondeterministic()(F.col(text)).alias(OWN + "weight"))
    return found.select(*keep, OWN + "weight.*")


def gumbel(id_column: str, seed: int) -> DataFrame:
    """A Gumbel number in thousandths, floored, that follows from seed and id; a null id counts as empty."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(named.cast("binary"), 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def drawn(scored: DataFrame, percent: int, min_words: int, id_column: str) -> DataFrame:
    """`scored` (written) with rank: 1, 2, 3, ... for the drawn rows, null for the others.

    Scores are whole numbers in thousandths, so they take few values however many rows there are: their
    counts give the first rank of each, and rows are numbered inside a score by id.
    """
    able = F.col("n_words") >= min_words
    before = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)  # one row a score
    counted = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias(OWN + "n"))
    counted = counted.withColumn(OWN + "before", F.coalesce(F.sum(OWN + "n").over(before), F.lit(0)))
    counted = written(counted, "resample-scores")
    total = counted.agg(F.sum(OWN + "n")).first()[0] or 0
    draw = percent * total // 100
    counted = counted.where(F.col(OWN + "before") < draw)
    least = counted.agg(F.min("score")).first()[0]
    if least is None:
        return scored.withColumn("rank", F.lit(None).cast("bigint"))
    chosen = able & (F.col("score") >= least)
    spread = None
    if scored.schema[id_column].dataType.typeName() in ("byte", "short", "integer", "long"):
        low, high = scored.agg(F.min(id_column), F.max(id_column)).first()
        if low is not None:  # parts of a score are ranges of ids; null ids come last
            share = (F.col(id_column).cast("double") - float(low)) / (float(high) - float(low) + 1.0)
            spread = F.floor(F.least(F.coalesce(share, F.lit(1.0)), F.lit(1.0)) * (2**32 - 1)).cast("bigint")
    rows = scored.where(chosen).withColumn(OWN + "null", F.col(id_column).isNull())
    others = [c for c in scored.columns if c not in ("score", id_column)]
    ranked = numbered(rows, ["score"], [OWN + "null", id_column, *others], OWN + "at", spread=F.lit(0) if spread is None else spread)
    ranked = ranked.join(counted, "score").withColumn("rank", F.col(OWN + "before") + F.col(OWN + "at") + 1)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = scored.where(~F.coalesce(chosen, F.lit(False))).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*scored.columns, "rank").union(rest)


def importance_resample(
    df: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7, size: int = 2, buckets: int = 10000,
    id_column: str = "doc_id", text: str = "text", target_text: str = "text", keep: tuple[str, ...] = (),
) -> DataFrame:
    """Every row's id, n_words, n_features, weight, score and rank; rank is null for rows that are not drawn.

    The weight is the mean gain of a text's features: how much more frequent their buckets are in `target`. The
    score adds a Gumbel number of the id, so that the highest scores are a draw without replacement in
    proportion to exp(weight / 1000). Of the rows with `min_words` words, `percent` in a hundred are
    drawn, ties by the smaller id, null ids last.

    Null and empty texts have no features and weight 0. Rows that agree in everything are drawn each, and may
    swap ranks. An empty table gives an empty one; an empty target leaves the gains to the corpus' own counts.
    Columns `keep` are handed on, others are not read.
    """
    small_batches(df.sparkSession)
    gain = gains(bucket_counts(df, text, size, buckets), bucket_counts(target, target_text, size, buckets))
    found = weighted(df, gain, size, text, (id_column, *keep))
    scored = written(found.withColumn("score", F.col("weight") + gumbel(id_column, seed)), "resample-scored")
    return drawn(scored, percent, min_words, id_column)
