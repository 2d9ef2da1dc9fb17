"""Quality rules: text statistics, and the perplexity under a language model of each language.

The model is over UTF-8 bytes, so it knows every script and needs no vocabulary. Byte n-grams of all
documents are counted by Spark, a modified Kneser-Ney model of them is estimated with joins and
aggregations, and its probabilities are laid out in arrays by the hash of language and n-gram, which are
sent to all workers; a model too large for that is looked up by joins. Each document is scored by the model of its own language and rejected if its perplexity per word lies outside a
band of that language, which is taken from the median and the spread of all documents that pass the other
rules. The mean over a document's words spreads with one over the root of their number; so does the band.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.llm.common import OWN, small_batches
from jouleloom.operators.describe import values_at_ranks
from jouleloom.session import written

#: Bytes in the longest n-gram; eight at most, as an n-gram is kept in a long.
ORDER = 5
#: Bits of the hash of language and n-gram that tell model entries apart.
SLOT_BITS = 62
#: A model of more entries, of eight bytes and up to four for the directory, is not sent to the workers: up to twice as many as
#: half a GB of text gives, which is what time and memory were measured with.
BROADCAST = 1 << 22
#: Bytes of text whose n-grams are looked up together by joins, but for a longer text; and model entries packed at once.
PART_BYTES = 8 << 20
PIECE = 1 << 16
#: Different perplexities of a language that one task ranks at most.
RANKED = 1 << 20
#: n-grams that a task collects before it hands on what it has.
FLUSH = 1_000_000
#: Bytes of text whose n-grams are in memory at once, but for a longer text; and n-grams looked up at once.
GROUP = 1 << 19
LOOKUP = 1 << 17
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# The discounts in use where counts of counts can't give them.
PLAIN_DISCOUNTS = (0.5, 1.0, 1.5)

STATISTICS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


# --- statistics of a text


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a window of WINDOW words that the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seen = np.array([ids.setdefault(w, len(ids)) for w in words], np.uint64)
    if len(ids) == len(words):
        return 0
    base = np.uint64(0x9E3779B97F4A7C15)
    window = seen[:n].copy()
    for k in range(1, WINDOW):
        window = window * base + seen[k : n + k]
    _, back, times = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[back] > 1)
    if not len(starts):
        return 0
    edge = np.zeros(len(words) + 1, np.int64)
    edge[starts] += 1
    edge[starts + WINDOW] -= 1
    return int((np.cumsum(edge) > 0).sum())


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """The columns of STATISTICS. Words are runs without ASCII white space."""
    raw = text.encode()
    words = raw.split()
    spaces = len(raw) - sum(map(len, words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


# --- n-grams


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every byte of `texts`, as one long each, and the borders of the texts among them.

    Texts begin after ORDER - 1 zero bytes, which stand for the start.
    """
    start = bytes(ORDER - 1)
    joined = np.frombuffer(start + start.join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    packed = np.zeros(len(joined) - ORDER + 1, np.int64)
    for k in range(ORDER):
        packed <<= 8
        packed |= joined[k : k + len(packed)]
    ends = np.cumsum(sizes)
    at = np.repeat(np.arange(len(texts)) * (ORDER - 1), sizes) + np.arange(ends[-1] if len(ends) else 0)
    return packed[at], ends


def tally(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and how often they occur."""
    if times is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        return keys[first], np.diff(np.append(first, len(keys)))
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times, first)


def by_language(langs: pd.Series, texts: pd.Series) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """(language, rows, their texts) of a batch, in groups of about GROUP bytes; texts of no byte are left out."""
    waiting: dict[str, tuple[list[int], list[bytes], int]] = {}
    for row, (lang, text) in enumerate(zip(langs, texts, strict=True)):
        if not text:
            continue
        lang = lang or ""
        rows, raw, size = waiting.get(lang, ([], [], 0))
        rows.append(row)
        raw.append(text.encode())
        waiting[lang] = rows, raw, size + len(raw[-1])
        if waiting[lang][2] >= GROUP:
            yield lang, np.array(rows), raw
            del waiting[lang]
    for lang, (rows, raw, _) in waiting.items():
        yield lang, np.array(rows), raw


def gram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, gram, n): every byte n-gram of ORDER bytes of every text, by language; a null language is ''."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}
        size = 0

        def out() -> Iterator[pd.DataFrame]:
            for name, parts in held.items():
                keys, times = tally(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))
                yield pd.DataFrame({"lang": name, "gram": keys, "n": times})

        for batch in batches:
            for name, _, texts in by_language(batch["lang"], batch["text"]):
                found = tally(grams(texts)[0])
                held.setdefault(name, []).append(found)
                size += len(found[0])
            if size > FLUSH:
                held = {name: [tally(np.concatenate([k for k, _ in p]), np.concatenate([n for _, n in p]))] for name, p in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
            if size > FLUSH // 2:
                yield from out()
                held, size = {}, 0
        yield from out()

    parts = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInPandas(count, "lang string, gram bigint, n bigint")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# --- modified Kneser-Ney


def suffix(order: int) -> Column:
    return F.col("gram").bitwiseAND(F.lit((1 << 8 * (order - 1)) - 1))


def context(column: str = "gram") -> Column:
    return F.shiftright(column, 8)


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): the discounts of n-grams seen once, twice and more often."""
    n = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    usable = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)
    given = counts.groupBy("lang").agg(*n)
    for k, plain in enumerate(PLAIN_DISCOUNTS, 1):
        own = F.when(usable, k - (k + 1) * y * F.col(f"n{k + 1}") / F.nullif(F.col(f"n{k}"), F.lit(0.0)))
        given = given.withColumn(f"d{k}", F.when((own > 0) & (own < k), own).otherwise(plain))
    return given.select("lang", "d1", "d2", "d3")


def estimate(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For n = 1 to ORDER: (lang, gram, p), and (lang, context, back) with the weight left for shorter n-grams.

    `counts` is that of the longest n-grams; a shorter one counts the different bytes seen before it. The
    probabilities are interpolated with those of the shorter n-grams, down to an even one over all bytes.
    """
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        by_order[k] = written(by_order[k + 1].groupBy("lang", suffix(k + 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "ngram-counts")
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        seen = by_order[k].withColumn("context", context()).join(written(discounts(by_order[k]), "ngram-discounts"), "lang")
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        seen = seen.withColumn("taken", taken)
        back = seen.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("back"))
        p = seen.join(back, ["lang", "context"])
        shorter = F.lit(1 / 256)
        if k > 1:
            lower = out[-1][0].withColumnRenamed("gram", "tail").withColumnRenamed("p", "shorter")
            p, shorter = p.withColumn("tail", suffix(k)).join(lower, ["lang", "tail"]), F.col("shorter")
        p = p.select("lang", "gram", ((F.col("n") - F.col("taken")) / F.col("total") + F.col("back") * shorter).alias("p"))
        out.append((written(p, "ngram-model"), back.select("lang", "context", "back")))
    return out


# --- sorted hash arrays


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) ^ np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # fixed values of the SplitMix64 finalizer
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def directory_bits(n: int) -> int:
    return min(max(1, n.bit_length()), SLOT_BITS - 32)


def sorted_hash_array(slots: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The low 32 bits of ascending slots, their values, and where each run of equal high bits begins.

    There are as many runs as entries or up to twice as many, so the bits kept grow with the entries: of n
    entries, one that is missing is taken for another with a chance of about 2^-32.
    """
    bits = directory_bits(len(slots))
    slots = slots.astype(np.uint64)
    highs = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(SLOT_BITS - bits)
    begin = np.searchsorted(slots, highs).astype(np.uint32)
    return slots.astype(np.uint32), np.asarray(values).astype(np.float32), begin


class HashArray:
    """Look-ups in a `sorted_hash_array`."""

    def __init__(self, slots: np.ndarray, values: np.ndarray, begin: np.ndarray):
        self.slots, self.values, self.begin = slots, values, begin
        self.bits = (len(begin) - 1).bit_length() - 1

    def find(self, slots: np.ndarray) -> np.ndarray:
        """The place of each slot, or -1."""
        run = slots.astype(np.uint64) >> np.uint64(SLOT_BITS - self.bits)
        at, end = self.begin[run].astype(np.int64), self.begin[run + np.uint64(1)].astype(np.int64)
        low = slots.astype(np.uint32)
        found = np.full(len(slots), -1, np.int64)
        open_ = np.flatnonzero(at < end)
        while len(open_):
            here = at[open_]
            hit = self.slots[here] == low[open_]
            found[open_[hit]] = here[hit]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        return found


class Model:
    """Log probabilities of n-grams and log weights of contexts, per order, for all languages."""

    def __init__(self, entries: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.arrays = [HashArray(*e) for e in entries]

    def log_probability(self, packed: np.ndarray, seed: int) -> np.ndarray:
        parts = [self._log_probability(packed[i : i + LOOKUP], seed) for i in range(0, len(packed), LOOKUP)]
        return np.concatenate(parts) if parts else np.zeros(0, np.float32)

    def _log_probability(self, packed: np.ndarray, seed: int) -> np.ndarray:
        """Of the last byte of each n-gram given the bytes before it: the longest n-gram known, and the
        weights of the contexts that were too long."""
        out = np.zeros(len(packed), np.float32)
        rows, keys = np.arange(len(packed)), packed
        for k in range(ORDER, 0, -1):
            p, back = self.arrays[2 * (k - 1)], self.arrays[2 * (k - 1) + 1]
            at = p.find(slot(keys, seed, k, False))
            hit = at >= 0
            out[rows[hit]] += p.values[at[hit]]
            rows, keys = rows[~hit], keys[~hit]
            if not len(rows):
                return out
            at = back.find(slot(keys >> 8, seed, k, True))
            known = at >= 0
            out[rows[known]] += back.values[at[known]]
            keys = keys & ((1 << 8 * (k - 1)) - 1)
        out[rows] += np.float32(np.log(1 / 256))
        return out


def slot(keys: np.ndarray, seed: int, order: int, is_context: bool) -> np.ndarray:
    return mix(keys, seed) >> np.uint64(64 - SLOT_BITS)


def language_seed(lang: str) -> int:
    """A number below 2^63 for a language, the same on every worker."""
    import zlib

    return (zlib.crc32(lang.encode()) << 31) ^ zlib.crc32(lang.encode()[::-1])


def entry_counts(tables: list[tuple[DataFrame, DataFrame]]) -> list[int]:
    """How many n-grams each order has; the contexts of the next order are about as many."""
    parts = [p.select(F.lit(k).alias("k")) for k, (p, _) in enumerate(tables)]
    found = {r["k"]: r["n"] for r in reduce(DataFrame.union, parts).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    return [found.get(k, 0) for k in range(len(tables))]


def layout(tables: list[tuple[DataFrame, DataFrame]], counts: list[int]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The model's arrays, one entry for every n-gram and context; `counts` is that of `entry_counts`.

    Executors sort and pack them, about PIECE entries at a time; twelve bytes per entry come to the driver.
    """

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = np.zeros(len(b), np.int64)
            for (lang, array), rows in b.groupby(["lang", "array"]).indices.items():
                out[rows] = slot(b["key"].to_numpy()[rows], language_seed(lang), array // 2 + 1, bool(array % 2))
            yield pd.DataFrame({"array": b["array"], "slot": out, "piece": out >> (SLOT_BITS - b["bits"].to_numpy()), "value": np.log(b["value"])})

    def pack(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("slot")
        packed = own["slot"].to_numpy("<u8").tobytes(), own["value"].to_numpy("<f4").tobytes()
        return pd.DataFrame([(own["array"].iloc[0], own["piece"].iloc[0], *packed)], columns=["array", "piece", "slots", "values"])

    parts = []
    for k, pair in enumerate(tables):
        bits = F.lit(max(1, (counts[k] // PIECE).bit_length()))
        for is_context, t in enumerate(pair):
            parts.append(t.toDF("lang", "key", "value").withColumn("array", F.lit(2 * k + is_context)).withColumn("bits", bits))
    found = reduce(DataFrame.union, parts).mapInPandas(slots, "array int, slot bigint, piece bigint, value double")
    packed = found.groupBy("array", "piece").applyInPandas(pack, "array int, piece bigint, slots binary, values binary")
    got: dict[int, list] = {i: [] for i in range(2 * ORDER)}
    for r in packed.collect():
        got[r["array"]].append((r["piece"], bytes(r["slots"]), bytes(r["values"])))
    entries = []
    for i in range(2 * ORDER):  # what came from the executors goes as soon as its array is there
        own = sorted(got.pop(i))
        entries.append(sorted_hash_array(np.frombuffer(b"".join(s for _, s, _ in own), "<u8"), np.frombuffer(b"".join(v for _, _, v in own), "<f4")))
    return entries


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The entries of a `Model` of all of `df`."""
    small_batches(df.sparkSession)
    tables = estimate(written(gram_counts(df, text, lang), "ngram-counts"))
    return layout(tables, entry_counts(tables))


# --- look-ups by joins


def looked_up(asked: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(lang, gram, log_p) of distinct n-grams (lang, gram), by the same rule as `Model`."""
    rest = asked.select("lang", "gram", F.col("gram").alias("key"), F.lit(0.0).alias("weight"))
    out: list[DataFrame] = []
    for k in range(ORDER, 0, -1):
        p, back = tables[k - 1]
        tried = written(rest.join(p.withColumnRenamed("gram", "key"), ["lang", "key"], "left"), "ngram-lookups")
        out.append(tried.where("p IS NOT NULL").select("lang", "gram", (F.col("weight") + F.log("p")).alias("log_p")))
        missed = tried.where("p IS NULL").withColumn("context", context("key"))
        if missed.isEmpty():
            return reduce(DataFrame.union, out)
        shorter = F.col("key").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1)).alias("key")
        weight = F.col("weight") + F.coalesce(F.log("back"), F.lit(0.0))
        rest = missed.join(back, ["lang", "context"], "left").select("lang", "gram", shorter, weight.alias("weight"))
    return reduce(DataFrame.union, out).union(rest.select("lang", "gram", F.col("weight") + F.log(F.lit(1 / 256))))


def scored_by_joins(df: DataFrame, tables: list[tuple[DataFrame, DataFrame]], text: str, lang: str, out: str) -> DataFrame:
    """As `scored`, for a model of any size: each part of the texts asks for its different n-grams.

    An n-gram is asked for once by a part at most, so no key is hotter than there are parts.
    """
    row = OWN + "row"
    named = written(df.withColumn(row, F.monotonically_increasing_id()), "quality-rows")
    texts = named.select(F.col(row).alias("row"), F.coalesce(F.col(lang), F.lit("")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, size = None, 0
        for b in batches:
            parts = []
            for name, t in zip(b["row"], b["text"], strict=True):
                if part is None or size >= PART_BYTES:
                    part, size = name, 0
                parts.append(part)
                size += len(t.encode())
            yield b.assign(part=np.array(parts, np.int64))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, own in b.groupby("part"):
                for name, _, raw in by_language(own["lang"], own["text"]):
                    yield pd.DataFrame({"part": part, "lang": name, "gram": tally(grams(raw)[0])[0]})

    def score(own: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        known = known.sort_values(["code", "gram"])
        codes, key, logs = (known[c].to_numpy() for c in ("code", "gram", "log_p"))
        got = pd.DataFrame([statistics(t) for t in own["text"]], columns=[c.split()[0] for c in STATISTICS.split(", ")], dtype="int64")
        value = np.full(len(own), np.nan)
        for name, rows, raw in by_language(own["code"].astype(str), own["text"]):
            packed, ends = grams(raw)
            begin, end = np.searchsorted(codes, int(name)), np.searchsorted(codes, int(name), "right")
            found = logs[begin + np.searchsorted(key[begin:end], packed)]
            value[rows] = -np.add.reduceat(found, np.concatenate(([0], ends[:-1])))
        got["log_perplexity"] = value / got["n_words"].where(got["n_words"] > 0)
        return got.assign(row=own["row"].to_numpy())

    texts = written(texts.mapInPandas(cut, "row bigint, lang string, text string, part bigint"), "quality-texts")
    asked = written(texts.select("part", "lang", "text").mapInPandas(ask, "part bigint, lang string, gram bigint").distinct(), "quality-ngrams")
    known = looked_up(asked.select("lang", "gram").distinct(), tables)
    code = F.xxhash64("lang").alias("code")
    answers = asked.join(known, ["lang", "gram"]).select("part", code, "gram", "log_p")
    parts = texts.select("part", "row", code, "text").groupBy("part").cogroup(answers.groupBy("part"))
    scores = parts.applyInPandas(score, f"row bigint, {STATISTICS}, log_perplexity double")
    names = [c.split()[0] for c in STATISTICS.split(", ")] + ["log_perplexity"]
    return named.join(scores.select(F.col("row").alias(row), F.struct(*names).alias(out)), row).drop(row)


# --- rules


def scored(df: DataFrame, entries: list, text: str, lang: str, out: str) -> DataFrame:
    """`df` with a struct `out`: the STATISTICS of the text and log_perplexity, the natural logarithm per word, null without a word."""
    shared = df.sparkSession.sparkContext.broadcast(entries)

    @F.pandas_udf(STATISTICS + ", log_perplexity double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        lm = Model(shared.value)
        for langs, texts in batches:
            texts = texts.fillna("")
            own = pd.DataFrame([statistics(t) for t in texts], columns=[c.split()[0] for c in STATISTICS.split(", ")], dtype="int64")
            value = np.full(len(texts), np.nan)
            for name, rows, raw in by_language(langs, texts):
                packed, ends = grams(raw)
                logs = lm.log_probability(packed, language_seed(name))
                sums = np.add.reduceat(logs.astype(np.float64), np.concatenate(([0], ends[:-1])))
                value[rows] = -sums
            own["log_perplexity"] = value / own["n_words"].where(own["n_words"] > 0)
            yield own

    return df.withColumn(out, score.asNondeterministic()(F.coalesce(F.col(lang), F.lit("")), F.coalesce(F.col(text), F.lit(""))))


def medians(rows: DataFrame, column: Column) -> DataFrame:
    """(lang, v): the exact median of each language, of an even number the lower one of the two in the middle."""
    values = written(rows.groupBy("lang", column.alias("v")).agg(F.count(F.lit(1)).alias("rows")), "quality-values")
    counted = values.groupBy("lang").agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("values"))
    targets = counted.select("lang", F.lit("median").alias("name"), F.floor((F.col("n") - 1) / 2).alias("rank"), "values")
    return values_at_ranks(values, written(targets, "quality-targets"), ["lang"], RANKED).select("lang", "v")


def bands(rows: DataFrame) -> DataFrame:
    """(lang, middle, scale) of the log perplexity: the median, and the median deviation of one word.

    `rows` has lang, n_words and log_perplexity of the documents that the other rules keep. Both are exact, so that a
    verdict at the edge of a band does not depend on the order in which tasks end.
    """
    known = rows.where("log_perplexity IS NOT NULL")
    middle = written(medians(known, F.col("log_perplexity")).withColumnRenamed("v", "middle"), "quality-medians")
    away = F.abs(F.col("log_perplexity") - F.col("middle")) * F.sqrt("n_words")
    scale = medians(known.join(middle, "lang"), away).withColumnRenamed("v", "scale")
    return written(middle.join(scale, "lang"), "quality-bands")


def quality(df: DataFrame, keep: list[str] | None = None, text: str = "text", lang: str = "lang", out: str = "quality", width: float = 5.0, least: float = 0.3) -> DataFrame:
    """The columns `keep` of `df`, all by default, with a struct `out`.

    It holds the STATISTICS, log_perplexity, low, high, base_failed and kept. base_failed: fewer than 10
    words, or more than a fifth of the words in repeated windows. kept: not base_failed, and the perplexity
    in the band [low, high] of the language: the median, and around it `width` median deviations of a mean
    of so many words, `least` at least. Null and empty texts have no word, so they fail and have no band. Documents
    without a language form a group of their own. Rows that repeat are judged each and count each in the model; an
    empty table gives an empty one. A column named `out` is replaced.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c != out]
    own, failed, group = OWN + "scored", OWN + "failed", OWN + "lang"
    small_batches(df.sparkSession)
    tables = estimate(written(gram_counts(df, text, lang), "ngram-counts"))
    counts = entry_counts(tables)
    rows = scored(df, layout(tables, counts), text, lang, own) if sum(counts) + sum(counts[:-1]) <= BROADCAST else scored_by_joins(df, tables, text, lang, own)
    rows = rows.withColumn(group, F.coalesce(F.col(lang), F.lit("")))
    rows = rows.withColumn(failed, (F.col(own + ".n_words") < 10) | (100 * F.col(own + ".n_repeat_words") > 20 * F.col(own + ".n_words")))
    rows = written(rows.select(*[f"`{c}`" for c in keep], own, group, failed), "quality-scored")  # scored once, used twice
    passed = rows.where(~F.col(failed)).select(F.col(group).alias("lang"), own + ".n_words", own + ".log_perplexity")
    band = bands(passed).select(F.col("lang").alias(group), F.struct("middle", "scale").alias(OWN + "band"))
    words = F.col(own + ".n_words")
    # A mean of no words has no spread, and dividing by their number is an error.
    reach = F.when(words > 0, F.greatest(F.lit(width) * F.col(OWN + "band.scale") / F.sqrt(words), F.lit(least)))
    low, high = F.col(OWN + "band.middle") - reach, F.col(OWN + "band.middle") + reach
    inside = F.coalesce(F.col(own + ".log_perplexity").between(low, high), F.lit(False))
    verdict = F.struct(own + ".*", low.alias("low"), high.alias("high"), F.col(failed).alias("base_failed"), (~F.col(failed) & inside).alias("kept"))
    return rows.join(band, group, "left").withColumn(out, verdict).drop(own, failed, group, OWN + "band")
