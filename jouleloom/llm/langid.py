"""Language identification by a byte convolutional network, trained here in numpy.

Filters of several widths slide over the bytes of a fixed-length window; each filter keeps its largest
response in the window, and a softmax layer over these gives the languages. Whole texts are cut into
windows, all of which are scored, and their probabilities are averaged by the letters they hold.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jouleloom.llm.common import small_batches

#: Bytes of a window, and the widths of the filters, of which there are FILTERS each.
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16

#: The sample for training: at most this many documents of a language, and windows of a document.
SAMPLE = 1500
SAMPLE_WINDOWS = 4
EPOCHS = 4
BATCH = 64
RATE = 0.004

#: Windows that are scored together.
TOGETHER = 1024

UNKNOWN = "und"


def alphabet() -> np.ndarray:
    """What each byte counts as: capitals as small letters, ASCII that is no letter as a space."""
    out = np.arange(256, dtype=np.uint8)
    out[:128] = 32
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    return out


def windows(text: str) -> np.ndarray:
    """All bytes of a text in rows of WINDOW bytes and the bytes that the widest filter sees beyond.

    Runs of spaces are one space; the last row is filled with spaces. No row if nothing but spaces remains.
    """
    raw = alphabet()[np.frombuffer(text.encode(), np.uint8)]
    if len(raw):
        raw = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))]
    if not (raw != 32).any():
        return np.zeros((0, WINDOW + max(WIDTHS) - 1), np.uint8)
    n = -(-len(raw) // WINDOW)
    filled = np.full(n * WINDOW + max(WIDTHS) - 1, 32, np.uint8)
    filled[: len(raw)] = raw
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW + max(WIDTHS) - 1)[::WINDOW]


@dataclass
class Network:
    """filters: for each width an array (width, 256, FILTERS) with the weight of every byte at every place."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def responses(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For each width the responses (rows, WINDOW, FILTERS) without bias."""
        for weights in self.filters:
            total = weights[0][rows[:, :WINDOW]]
            for k in range(1, len(weights)):
                total += weights[k][rows[:, k : k + WINDOW]]
            yield total

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(np.concatenate([r.max(axis=1) for r in self.responses(rows)], axis=1) + self.bias, 0)

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        out = [softmax(self.pooled(rows[i : i + 128]) @ self.dense + self.dense_bias) for i in range(0, len(rows), 128)]
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, by filters, bias, dense weights and dense bias. They reach a filter only where its
    largest response was."""
    column = np.arange(net.filters[0].shape[2])
    places, best = [], []
    for r in net.responses(x):
        at = r.argmax(axis=1)
        places.append(at)
        best.append(np.take_along_axis(r, at[:, None, :], axis=1)[:, 0, :])
    raw = np.concatenate(best, axis=1) + net.bias
    hidden = np.maximum(raw, 0)
    error = softmax(hidden @ net.dense + net.dense_bias)
    error[np.arange(len(x)), y] -= 1
    error /= len(x)
    back = (error @ net.dense.T) * (raw > 0)
    grads = [np.zeros_like(w) for w in net.filters]
    for j, (grad, at) in enumerate(zip(grads, places, strict=True)):
        own = back[:, j * len(column) : (j + 1) * len(column)]
        for k in range(len(grad)):
            seen = np.take_along_axis(x, at + k, axis=1)
            np.add.at(grad[k], (seen, np.broadcast_to(column, seen.shape)), own)
    return [*grads, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def fit(rows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Train by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    filters = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    size = FILTERS * len(WIDTHS)
    net = Network(languages, filters, np.zeros(size, np.float32), rng.normal(0, 0.1, (size, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    weights = [*net.filters, net.bias, net.dense, net.dense_bias]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            grads = gradients(net, rows[order[i : i + BATCH]], labels[order[i : i + BATCH]])
            step += 1
            for w, g, m, v in zip(weights, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
    return net


def labelled_windows(df: DataFrame, text: str, lang: str, per_language: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of a bounded sample of the labelled texts in `df`, with the number of their language.

    Of every language the texts with the lowest hashes are taken, about `per_language` of them and twice as
    many at most over all languages; of a text SAMPLE_WINDOWS windows
    spread over the whole of it. Copies of a text count once.
    """
    known = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    times = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    languages = sorted(times)
    if not languages:
        return np.zeros((0, WINDOW + max(WIDTHS) - 1), np.uint8), np.zeros(0, np.int64), []
    share = F.lit(0.0)
    for name, n in times.items():
        share = F.when(F.col("lang") == name, min(1.0, per_language / n)).otherwise(share)
    place = F.xxhash64("text", "lang")
    drawn = known.where(F.pmod(place, F.lit(1 << 30)) < share * (1 << 30)).withColumn("place", place)

    def some(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, name, at in zip(b["text"], b["lang"], b["place"], strict=True):
                rows = windows(text)
                picked = range(len(rows)) if len(rows) <= SAMPLE_WINDOWS else np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int)
                out += [(name, at, rows[i].tobytes()) for i in picked]
            yield pd.DataFrame(out, columns=["lang", "place", "bytes"])

    bound = 2 * per_language * len(languages) * SAMPLE_WINDOWS
    # In order, so that a run over the bound takes the same windows; each task keeps no more than the bound.
    drawn = drawn.mapInPandas(some, "lang string, place bigint, bytes binary").dropDuplicates()
    got = drawn.orderBy("place", "lang", "bytes").limit(bound).toPandas()
    rows = np.frombuffer(b"".join(got["bytes"]), np.uint8).reshape(len(got), -1)
    number = {name: i for i, name in enumerate(languages)}
    return rows, got["lang"].map(number).to_numpy(np.int64), languages


def train(df: DataFrame, text: str = "text", lang: str = "lang", per_language: int = SAMPLE) -> Network:
    """A network for the languages of `df`; one without languages if no text is labelled."""
    small_batches(df.sparkSession)
    rows, labels, languages = labelled_windows(df, text, lang, per_language)
    return fit(rows, labels, languages)


def identify(net: Network, text: str | None) -> tuple[str, float]:
    """The language of a text and its probability; UNKNOWN and 0 without a letter or a language to choose."""
    return identify_all(net, [text])[0]


def identify_all(net: Network, texts: Sequence[str | None]) -> list[tuple[str, float]]:
    """`identify` of several texts, whose windows are scored together, TOGETHER at once or those of one long text."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    waiting: list[tuple[int, np.ndarray]] = []

    def score() -> None:
        rows = np.concatenate([r for _, r in waiting])
        weight = (rows[:, :WINDOW] != 32).sum(axis=1)
        begin = np.cumsum([0, *(len(r) for _, r in waiting[:-1])])
        sums = np.add.reduceat(net.probabilities(rows) * weight[:, None], begin)
        mean = sums / np.add.reduceat(weight, begin)[:, None]
        for (i, _), own in zip(waiting, mean, strict=True):
            best = int(own.argmax())
            out[i] = net.languages[best], float(min(1.0, own[best]))
        waiting.clear()

    for i, text in enumerate(texts):
        if text and net.languages and any(map(str.isalpha, text)):
            rows = windows(text)
            if len(rows):
                waiting.append((i, rows))
                if sum(len(r) for _, r in waiting) >= TOGETHER:
                    score()
    if waiting:
        score()
    return out


def predict(text: Column, net: Network, spark) -> Column:
    """A struct (lang_pred, score) for a text column."""
    parts = spark.sparkContext.broadcast((net.languages, net.filters, net.bias, net.dense, net.dense_bias))

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Network(*parts.value)
        for texts in batches:
            yield pd.DataFrame(identify_all(own, texts.tolist()), columns=["lang_pred", "score"])

    return identified.asNondeterministic()(text)


def identify_language(df: DataFrame, net: Network, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, lang_pred and score of every row; only the text is looked at.

    Null texts and texts without a letter are UNKNOWN with score 0. Rows that repeat are each predicted; an
    empty table gives an empty one.
    """
    small_batches(df.sparkSession)
    found = df.select(*keep, predict(F.col(text), net, df.sparkSession).alias("__llm_found"))
    return found.select(*keep, "__llm_found.*")
