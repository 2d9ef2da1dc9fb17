"""Harmonic packing of token sequences.

A document is cut into full sequences and a rest; the rest is cut where the parts fit the reciprocals of
the capacity. A piece of length n belongs to class k = capacity div n, and k pieces of a class fill one
sequence, whatever worker they come from: places are given out by global numbers inside the class, which
workers know from the counts of the others. Lengths below the root of the capacity have classes of their own, and
above it there is one for each k below the root, so classes are at most twice the root. Of each fewer than k
pieces are left over, at most `most_left` altogether whatever the size of the corpus; these are packed best fit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, numbered, small_batches
from jouleloom.llm.tokens import PlainIds
from jouleloom.session import written

#: A rest is cut if sequences of such pieces would be padded by more than this part of the capacity.
SLACK = 64

PIECES = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,ids:binary>>"


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document.

    After the full sequences the rest goes as it is if a sequence of such rests has little padding, otherwise the
    largest reciprocal of the capacity below it is cut off; each cut at least halves what remains. Pieces of a few
    tokens leave less than one of them as padding, so cuts end there.
    """
    out = [(s, capacity) for s in range(0, length - capacity + 1, capacity)]
    start = len(out) * capacity
    while start < length:
        rest = length - start
        k = capacity // rest
        if capacity - k * rest > capacity // SLACK:
            rest = capacity // (k + 1)
        out.append((start, rest))
        start += rest
    return out


def most_left(capacity: int) -> int:
    """The most pieces that can be left over: in each class one less than fill a sequence."""
    return sum(k - 1 for k in {capacity // n for n in range(1, capacity + 1)})


def token_pieces(df: DataFrame, path: str, capacity: int, end_id: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """One row per piece: the columns `keep`, start, length, ids_crc32, doc_tokens and, if asked for, ids.

    A document is its token ids followed by `end_id`; a null text is empty and so one id long.
    """
    small_batches(df.sparkSession)
    last = end_id.to_bytes(4, "little")

    @F.pandas_udf(f"struct<doc_tokens:bigint,pieces:{PIECES}>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = PlainIds(path)
        for texts in batches:
            totals, pieces = [], []
            for ids in encoder.of(texts.tolist()):
                ids += last
                own = []
                for start, length in cuts(len(ids) // 4, capacity):
                    part = ids[4 * start : 4 * (start + length)]
                    own.append((start, length, zlib.crc32(part), part if with_ids else None))
                totals.append(len(ids) // 4)
                pieces.append(own)
            yield pd.DataFrame({"doc_tokens": totals, "pieces": pieces})

    done = df.select(*keep, cut.asNondeterministic()(F.coalesce(F.col(text), F.lit(""))).alias(OWN + "cut"))
    piece = F.col(OWN + "piece")
    return done.select(*keep, F.col(OWN + "cut.doc_tokens").alias("doc_tokens"), F.explode(OWN + "cut.pieces").alias(OWN + "piece")).select(
        *keep, piece["start"].alias("start"), piece["length"].alias("length"), piece["ids_crc32"].alias("ids_crc32"), "doc_tokens",
        *([piece["ids"].alias("ids")] if with_ids else []),
    )


def harmonic(pieces: DataFrame, capacity: int, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`pieces` with sequence_id, offset and class. `pieces` is read several times: hand in a written table.

    Sequence ids have no gaps: full bins class by class, then the sequences of what is left over.
    """
    order = [*keep, "start", "length", "ids_crc32", "doc_tokens"]
    k = F.floor(F.lit(capacity) / F.col("length")).cast("int")
    classed = numbered(pieces.withColumn("class", k), ["class"], order, OWN + "n")
    every = Window.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)  # one row a class
    sizes = (
        pieces.groupBy(k.alias("class"))
        .agg(F.count(F.lit(1)).alias(OWN + "all"))
        .withColumn(OWN + "bins", F.floor(F.col(OWN + "all") / F.col("class")))
        .withColumn(OWN + "base", F.coalesce(F.sum(OWN + "bins").over(every), F.lit(0)))
        .withColumn(OWN + "after", F.sum(OWN + "bins").over(Window.partitionBy(F.lit(0))))
        .drop(OWN + "all")
    )
    placed = written(
        classed.join(F.broadcast(sizes), "class")  # one row a class
        .withColumn(OWN + "bin", F.floor(F.col(OWN + "n") / F.col("class")))
        .withColumn("sequence_id", F.when(F.col(OWN + "bin") < F.col(OWN + "bins"), F.col(OWN + "base") + F.col(OWN + "bin")))
        .drop(OWN + "bin", OWN + "bins", OWN + "base"),
        "packing-bins",
    )
    inside = Window.partitionBy("sequence_id").orderBy(OWN + "n").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).alias("offset")
    full = placed.where(F.col("sequence_id").isNotNull())
    alone = full.where("class = 1").withColumn("offset", F.lit(0).cast("bigint"))
    shared = full.where("class > 1").select("*", offset)

    columns = [*pieces.columns, "class", "sequence_id", "offset"]
    rest = placed.where(F.col("sequence_id").isNull()).drop("sequence_id", OWN + "n")
    schema = rest.select("*", F.lit(0).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")).schema
    # One group of at most `most_left` rows; all of them carry the number of full bins.
    fitted = rest.groupBy(OWN + "after").applyInPandas(lambda left: best_fit(left, capacity, order), schema)
    fitted = fitted.withColumn("sequence_id", F.col("sequence_id") + F.col(OWN + "after"))
    return alone.select(columns).union(shared.select(columns)).union(fitted.select(columns))


def best_fit(left: pd.DataFrame, capacity: int, order: list[str]) -> pd.DataFrame:
    """Place the pieces left over, the longest first, each where least room remains."""
    left = left.sort_values(["length", *[c for c in order if c != "length"]], ascending=False, kind="stable")
    used: list[int] = []
    bins, offsets = [], []
    for length in left["length"]:
        at = max((i for i, u in enumerate(used) if u + length <= capacity), key=used.__getitem__, default=None)
        if at is None:
            at = len(used)
            used.append(0)
        bins.append(at)
        offsets.append(used[at])
        used[at] += length
    return left.assign(sequence_id=bins, offset=offsets)


def pack(df: DataFrame, path: str, capacity: int = 1024, end_id: int = 0, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False) -> DataFrame:
    """All documents in sequences of at most `capacity` tokens; see `harmonic` and `token_pieces`.

    Null and empty texts are the end id alone. Rows that repeat are packed each; an empty table gives an
    empty one. Other columns of the input are not read.
    """
    pieces = written(token_pieces(df, path, capacity, end_id, text, keep, with_ids), "packing-pieces")
    return harmonic(pieces, capacity, keep)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and the ids of every sequence, from `pack(..., with_ids=True)`.

    A sequence holds at most `capacity` ids, so a group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
