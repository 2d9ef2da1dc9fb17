"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A block of the benchmark goes to all workers, so documents are read once, where they lie, and nothing of them is
shuffled. A passage is what lies around word n-grams that the benchmark has, too. Its n-grams are seeds, the rarest
in the benchmark first: a passage and an item make a pair on the rarest n-gram both have, once. Of these pairs, those that
share enough words to reach the threshold at all are scored by local alignment, which tolerates words
that were exchanged, left out or put in. What is found in a document does not depend on the other documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, small_batches
from jouleloom.session import written

#: Words of an n-gram; a shorter item is an n-gram of its own, and one word alone is no item.
SIZE = 4
LEAST_WORDS = 2
MATCH, MISMATCH, GAP = 2, -1, -1
#: The lowest threshold that can be asked for, and how far passages reach for it, in longest items.
LEAST = 0.3
REACH = 3
#: Characters of benchmark text that are searched in one scan; a larger benchmark takes several.
BLOCK_CHARS = 8_000_000
#: Cells in a row of the alignment tables of one batch of pairs.
CELLS = 250_000
#: Words that the passages around neighbouring hits may grow by before they are divided, and pairs that are aligned together.
LONG = 10_000
TOGETHER = 256

# Blocks of scripts written without spaces, whose characters count as words: Thai and Lao, Myanmar, Khmer, kana,
# Chinese characters with their extensions.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(f"(?=[{UNSPACED}])[^\\W_]|[^\\W_{UNSPACED}]+")


def words(text: str) -> list[str]:
    """Lower-case runs of letters and digits; of scripts without spaces every character."""
    return WORD.findall(text.lower())


def gram_keys(numbers: np.ndarray, known: int, size: int = SIZE) -> np.ndarray:
    """A key for the `size` words from every place on; `known` is the number of different words."""
    n = len(numbers) - size + 1
    keys = np.full(max(n, 0), size, np.uint64)
    for k in range(size if n > 0 else 0):
        keys = keys * np.uint64(known + 1) + numbers[k : n + k].astype(np.uint64)
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def listed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where the values of each begin, and the values; pairs that repeat count once."""
    pairs = np.unique(np.stack([keys, values], axis=1), axis=0) if len(keys) else np.zeros((0, 2), np.int64)
    found, first = np.unique(pairs[:, 0], return_index=True)
    return found, np.append(first, len(pairs)), pairs[:, 1].astype(np.int32)


class Items:
    """A block of the benchmark: a number for each of its words, which items have a word and an n-gram."""

    def __init__(self, texts: Sequence[str]):
        cut = [words(t) for t in texts]
        self.numbers = {w: i for i, w in enumerate(sorted({w for c in cut for w in c}))}
        self.items = [np.array([self.numbers[w] for w in c], np.int32) for c in cut]
        self.lengths = np.array([len(i) for i in self.items], np.int64)
        known = len(self.numbers)
        grams = [gram_keys(i, known, min(SIZE, len(i))) if len(i) >= LEAST_WORDS else np.zeros(0, np.int64) for i in self.items]
        none = np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(g) for g in grams])
        self.keys, self.begin, self.owners = listed(np.concatenate([*grams, none]), owner)
        self.sizes = sorted({min(SIZE, len(i)) for i in self.items if len(i) >= LEAST_WORDS})
        # Of every word the items that have it, and how often.
        word = np.concatenate([*self.items, none]).astype(np.int64)
        own = np.repeat(np.arange(len(texts)), self.lengths)
        pairs, self.times = np.unique(np.stack([word, own], axis=1), axis=0, return_counts=True)
        self.word_owners = pairs[:, 1].astype(np.int32)
        self.word_begin = np.searchsorted(pairs[:, 0], np.arange(known + 1))
        self.longest = int(self.lengths.max(initial=0))

    def pairs(self, passage: np.ndarray, grams: np.ndarray, threshold: float) -> np.ndarray:
        """The items that share an n-gram with a passage and have enough words in it, those on the rarest n-grams first."""
        at = np.searchsorted(self.keys, grams)
        rarest = at[np.argsort(self.begin[at + 1] - self.begin[at], kind="stable")]
        met = np.concatenate([self.owners[self.begin[g] : self.begin[g + 1]] for g in rarest])
        found, first = np.unique(met, return_index=True)
        found = found[np.argsort(first)]
        own = np.unique(passage[passage >= 0])
        places = np.concatenate([np.arange(self.word_begin[w], self.word_begin[w + 1]) for w in own])
        held = np.bincount(self.word_owners[places], self.times[places], minlength=len(self.items))[found]
        need = np.where(self.lengths[found] < SIZE, self.lengths[found], threshold * self.lengths[found])
        return found[held >= need]


def passages(text: str, numbers: dict[str, int], keys: np.ndarray, reach: int, sizes: Sequence[int] = (SIZE,)) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first word, word numbers or -1, n-gram keys hit) of the passages of a text: `reach` words around hits.

    A text of n words gives at most about 2 n words of passages.
    """
    found = words(text)
    own = np.fromiter(map(numbers.get, found, [-1] * len(found)), np.int32, len(found))
    run = np.cumsum(np.concatenate(([0], own < 0)))
    hits = []
    for size in sizes:
        n = len(own) - size + 1
        if n < 1:
            continue
        at = np.flatnonzero(run[size:] == run[:n])  # all words are known
        if not len(at):
            continue
        grams = gram_keys(own, len(numbers), size)[at]
        hit = keys[np.minimum(np.searchsorted(keys, grams), len(keys) - 1)] == grams
        hits.append((at[hit], np.full(int(hit.sum()), size), grams[hit]))
    if not hits:
        return
    at, size, grams = (np.concatenate(x) for x in zip(*hits, strict=True))
    if not len(at):
        return
    order = np.argsort(at, kind="stable")
    at, size, grams = at[order], size[order], grams[order]
    starts, stops = np.maximum(at - reach, 0), np.maximum.accumulate(np.minimum(at + size + reach, len(own)))
    first = np.flatnonzero(np.concatenate(([True], starts[1:] > stops[:-1])))
    overlap = 2 * reach + SIZE
    for i, j in zip(first, np.append(first[1:], len(at)), strict=True):
        begin, end = int(starts[i]), int(stops[j - 1])
        # Long ones are divided and overlap by as much as lies around a hit.
        for a in range(begin, max(end - overlap, begin + 1), LONG):
            b = min(a + LONG + overlap, end)
            inside = grams[i:j][(at[i:j] >= a) & (at[i:j] + size[i:j] <= b)]
            if len(inside):
                yield a, own[a:b], np.unique(inside)


def align(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """Best local alignment of each (passage, item): score, and the passage's words [start, stop) in it.

    All pairs of a batch go through the rows of the table together. A cell holds the score in its high and
    what remains after the start in its low 32 bits, so that the larger of two numbers is the better
    score and, among equal ones, the longer passage.
    """
    out: list[tuple[int, int, int]] = [(0, 0, 0)] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda i: len(pairs[i][0]))
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and (end + 1 - begin) * (len(pairs[order[end]][0]) + 1) <= CELLS:
            end += 1
        chosen = order[begin:end]
        for i, best in zip(chosen, _align_batch([pairs[i] for i in chosen]), strict=True):
            out[i] = best
        begin = end
    return out


def _align_batch(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    wide, deep = max(len(p) for p, _ in pairs), max(len(i) for _, i in pairs)
    passage, item = np.full((len(pairs), wide), -1, np.int32), np.full((len(pairs), deep), -2, np.int32)
    for r, (p, i) in enumerate(pairs):
        passage[r, : len(p)], item[r, : len(i)] = p, i
    one = np.int64(1) << 32
    low = one - 1
    fresh = low - np.arange(wide + 1, dtype=np.int64)  # score 0, an alignment that starts at this word
    drift = np.arange(1, wide + 1, dtype=np.int64) * (-GAP * one)
    row = np.broadcast_to(fresh, (len(pairs), wide + 1)).copy()
    best, stop = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    for k in range(deep):
        same = passage == item[:, k : k + 1]
        cell = row[:, :-1] + np.where(same, MATCH * one, MISMATCH * one)
        np.maximum(cell, row[:, 1:] + GAP * one, out=cell)
        cell = np.maximum.accumulate(cell + drift, axis=1) - drift  # words of the passage left out
        cell = np.where(cell < one, fresh[1:], cell)
        row[:, 1:] = np.where((item[:, k] >= 0)[:, None], cell, row[:, 1:])
        at = row.argmax(axis=1)
        value = row[np.arange(len(pairs)), at]
        better = (value >= one) & (value > best)
        best[better], stop[better] = value[better], at[better]
    return [(int(b >> 32), int(low - (b & low)), int(s)) if b else (0, 0, 0) for b, s in zip(best, stop, strict=True)]


def found_in(text: str | None, items: Items, threshold: float) -> list[tuple[int, int, float, int, int]]:
    """(item, its words, score, start, stop) of the items in a text: of each the best place, of equal ones the first.

    REACH times the longest item on either side of a hit has room for all that an alignment can skip and
    still score LEAST: with matches for 2 and gaps for 1 it spans less than 2 - LEAST + 1 items. Items of fewer than
    SIZE words count only whole.
    """
    best: dict[int, tuple[float, int, int]] = {}
    waiting: list[tuple[int, np.ndarray, int]] = []

    def score() -> None:
        for (start, _, item), (points, x, y) in zip(waiting, align([(p, items.items[i]) for _, p, i in waiting]), strict=True):
            n = int(items.lengths[item])
            value = points / (MATCH * n)
            if value >= (threshold if n >= SIZE else 1.0):
                place = (value, -(start + x), start + y)
                best[item] = max(best.get(item, place), place)
        waiting.clear()

    if text and len(items.keys):
        for start, passage, grams in passages(text, items.numbers, items.keys, REACH * items.longest, items.sizes):
            for item in items.pairs(passage, grams, threshold):
                waiting.append((start, passage, int(item)))
                if len(waiting) >= TOGETHER:
                    score()
        score()
    return [(item, int(items.lengths[item]), value, -back, stop) for item, (value, back, stop) in sorted(best.items())]


FOUND = "array<struct<item:bigint,n_words:bigint,score:double,start:bigint,stop:bigint>>"


def found_column(spark: SparkSession, items: Items, threshold: float, text: Column) -> Column:
    """What `found_in` finds in a text column."""
    shared = spark.sparkContext.broadcast(items)

    @F.pandas_udf(FOUND)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([found_in(t, shared.value, threshold) for t in texts], dtype=object)

    return search.asNondeterministic()(text)


def blocks(benchmark: DataFrame) -> Iterator[list]:
    """The rows of `benchmark` (item, text) in parts of about BLOCK_CHARS characters, one after the other."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS))
    for i in range(n):
        part = benchmark if n == 1 else benchmark.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield part.collect()


def known_items(benchmark: DataFrame, item: str, item_text: str, threshold: float) -> DataFrame:
    if threshold < LEAST:
        raise ValueError(f"passages are kept for scores of {LEAST} or more")
    return benchmark.where(F.col(item_text).isNotNull()).select(F.col(item).alias("item"), F.col(item_text).alias("text")).distinct()


def leaks(df: DataFrame, benchmark: DataFrame, threshold: float = 0.4, id_column: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item, n_words, score, start, stop): documents that hold a benchmark item, and where (words, from 0).

    The score is that of the best local alignment as a part of an item copied whole; at `threshold` or more,
    LEAST at least, it counts. Items of two or three words count only if they are copied whole; items of one word
    are not searched for, and neither null items nor null texts match anything. Copies of an item (id and text)
    are one item, and rows that agree in id and text come out once per item. Other columns are not read. Empty
    tables, of documents or of items, give an empty one.
    """
    spark = df.sparkSession
    small_batches(spark)
    known = known_items(benchmark, item, item_text, threshold)
    kind = known.schema["item"].dataType.simpleString()
    parts = []
    for rows in blocks(known):
        names = spark.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], f"number bigint, item {kind}")
        found = df.select(F.col(f"`{id_column}`").alias("id"), found_column(spark, Items([r["text"] for r in rows]), threshold, F.col(f"`{text}`")).alias("found"))
        # Matches are few; they are written so that documents are searched once.
        each = written(found.select("id", F.inline("found")).distinct(), "benchmark-matches")
        parts.append(each.withColumnRenamed("item", "number").join(names, "number").select("id", "item", "n_words", "score", "start", "stop"))
    return reduce(DataFrame.union, parts)


def decontaminate(df: DataFrame, benchmark: DataFrame, threshold: float = 0.4, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `df`, all columns as they are, that hold no benchmark item; see `leaks`. Nothing is shuffled."""
    spark = df.sparkSession
    small_batches(spark)
    out = OWN + "found"
    kept = df
    for rows in blocks(known_items(benchmark, "item_id", "text", threshold)):
        kept = kept.withColumn(out, found_column(spark, Items([r["text"] for r in rows]), threshold, F.col(f"`{text}`")))
        kept = kept.where(F.size(out) == 0).drop(out)
    return kept
