"""Interaction of filters: what each removes, and would remove, in every order they can be applied in.

A row either passes or fails a filter, whatever the others do, so all that matters of a row is the set of
filters it fails. Rows are counted by that set first; there are 2^k sets for k filters. Then sets and orders are
combined as matrices over (min, +): a set is 0 where a filter fails the row and infinite elsewhere, an order is
the place of every filter in it (the inverse of the permutation), and the minimum over the filters of their sum
is the step at which the order removes the rows of the set, infinite if it keeps them. Weighted counts scattered
by that step give what is removed, kept, redundant and lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, small_batches

FILTERS = "ABCDE"
#: The fewest words, the least share of distinct words and the largest of capitals (in hundredths), and characters not wanted.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, UNWANTED = 200, 50, 3, "#$%&*|"

CAPITALS = bytes(range(65, 91))
INFINITE = np.iinfo(np.int64).max // 2


def failed(text: str | None) -> int:
    """The filters A to D that a text fails, one bit each; words are runs without ASCII white space."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    checks = (
        len(words) < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT * len(words),
        100 * (len(raw) - len(raw.translate(None, CAPITALS))) > MAX_CAPITALS * len(text),
        any(c in text for c in UNWANTED),
    )
    return sum(bit << k for k, bit in enumerate(checks))


def failed_column(text: Column) -> Column:
    @F.pandas_udf("int")
    def check(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([failed(t) for t in texts], dtype="int32")

    return check.asNondeterministic()(text)


def removal_steps(n_filters: int, orders: np.ndarray) -> np.ndarray:
    """For every set of filters (row) and order (column) the step, from 0, at which the order removes the set.

    The product of the mask matrix (sets x filters) and the place matrix (filters x orders) over (min, +).
    """
    sets = np.arange(1 << n_filters)
    masks = np.where(sets[:, None] >> np.arange(n_filters) & 1, 0, INFINITE)
    places = np.argsort(orders, axis=1).T  # the inverse of a permutation is what sorts it
    steps = np.full((len(sets), len(orders)), INFINITE)
    for f in range(n_filters):
        np.minimum(steps, masks[:, f, None] + places[f], out=steps)
    return steps


def audit(counts: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> pd.DataFrame:
    """All orders of the filters over rows counted by the set they fail, in all, good and toxic.

    A set's place is its number as bits. One row per order and step (from 1); see `filter_audit`.
    """
    n = len(counts).bit_length() - 1
    orders = np.array(list(permutations(range(n))), np.int64)
    steps = removal_steps(n, orders)
    sets, columns = np.nonzero(steps < INFINITE)
    cells = columns * n + steps[sets, columns]

    def scatter(weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(orders) * n, np.int64)
        np.add.at(out, cells, weights[sets])
        return out.reshape(len(orders), n)

    removed = scatter(counts)
    failing = np.array([counts[np.arange(1 << n) >> f & 1 == 1].sum() for f in range(n)])
    shapley = np.zeros(n, np.int64)
    np.add.at(shapley, orders.ravel(), removed.ravel())
    return pd.DataFrame(
        {
            "filter_order": np.repeat(["".join(FILTERS[f] for f in o) for o in orders], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            "kept": (counts.sum() - np.cumsum(removed, axis=1)).ravel(),
            "removed": removed.ravel(),
            # A row that fails a filter is removed at its step or was before.
            "redundant": (failing[orders] - removed).ravel(),
            "unique_fails": counts[1 << orders].ravel(),
            "good_lost": scatter(good).ravel(),
            "toxic_lost": scatter(toxic).ravel(),
            "shapley": shapley[orders].ravel(),
        }
    )


COLUMNS = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"


def failure_counts(df: DataFrame, labels: DataFrame, part: str, id_column: str, text: str) -> DataFrame:
    """(part, mask, n, good, toxic): rows of every part by the set of filters they fail, whole and labelled.

    Only ids and digests of texts are shuffled. Rows of one text agree in the filters A to D, so they are counted
    per text, part and label with the smallest id among them; E then fails all but those of the smallest id.
    """
    small_batches(df.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.sha2(whole.cast("binary"), 256).alias("digest"), failed_column(whole).alias("mask")
    )
    alike = rows.groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = labels.groupBy(F.col(id_column).alias("id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    told = alike.join(known, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # A null id is smaller than none and none is smaller than it.
    named = F.col("id").isNotNull()
    texts = told.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min(F.when(named, F.struct("id", "n"))).alias("low"), F.sum(F.when(named, F.col("n")).otherwise(0)).alias("named")
    )
    first = texts.groupBy("digest").agg(F.min("low.id").alias("first"))
    at_first = F.when(F.col("low.id") == F.col("first"), F.col("low.n")).otherwise(0)
    split = texts.join(first, "digest").withColumn("copies", F.col("named") - at_first)
    both = F.array(
        F.struct(F.col("mask"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << FILTERS.index("E"))).alias("mask"), F.col("copies").alias("n")),
    )
    of = F.col("of.n")
    counted = split.select("part", "good", "toxic", F.explode(both).alias("of")).groupBy("part", F.col("of.mask").alias("mask"))
    return counted.agg(F.sum(of).alias("n"), F.sum(F.when(F.col("good"), of).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), of).otherwise(0)).alias("toxic"))


def filter_audit(df: DataFrame, labels: DataFrame, part: str = "lang", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per value of `part` (null: empty), order of the filters A to E and step.

    A: under 200 words. B: under half of them distinct. C: over 3 % capitals A-Z. D: holds one of #$%&*|.
    E: a row of a smaller id has the same text. Columns: filter_order, step (from 1), kept after the step, removed
    by it, redundant (fails its filter, removed earlier), unique_fails (fails its filter only), good_lost and
    toxic_lost (removed by it and labelled quality 1, toxic 1), shapley (removed by its filter in all orders).

    Null and empty texts are empty and equal. Rows that repeat count each and fail E only for a smaller id; a null id
    is not compared. An id labelled several times is good, or toxic, if one label says so. Without rows there is no
    part and no row. Other columns are not read. Groups hold 32 rows: a part's sets of failed filters.
    """
    counted = failure_counts(df, labels, part, id_column, text)
    size = 1 << len(FILTERS)

    def order_all(rows: pd.DataFrame) -> pd.DataFrame:
        by = [np.bincount(rows["mask"], rows[c], minlength=size).astype(np.int64) for c in ("n", "good", "toxic")]
        return audit(*by).assign(part=rows["part"].iloc[0])[[c.split()[0] for c in COLUMNS.split(", ")]]

    return counted.groupBy("part").applyInPandas(order_all, COLUMNS)
