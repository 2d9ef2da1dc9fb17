"""Token counts and token ids of whole texts, in Arrow batches.

Long texts are cut at safe boundaries: before a single space between two ASCII letters, and between East Asian
punctuation and the character after it. The byte-level pattern of the tokenizer ends a word there whatever
stands around it, so the ids of a text are the ids of its parts in order. Parts go to the tokenizer in batches
of equal bytes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from jouleloom.llm.common import small_batches

SAFE = re.compile("(?<=[A-Za-z])(?= [A-Za-z])|(?<=[、。！，：；？])(?=[一-鿿ぁ-ゖァ-ヺ])")
#: Characters of a part, and bytes of the parts in one batch, about.
PART = 1 << 15
BATCH = 1 << 18

#: Scripts whose letters, digits and spaces are the same in all versions of Unicode in use.
PLAIN = re.compile("[\t-\r -~\xa1-ɏͰ-ӿ]*")
PIECE = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
BOUNDARY = re.compile(r"(?<=[^ \t-\r])(?=[ \t-\r])")
#: White space beyond ASCII, which may be one token with what follows.
WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: About how many bytes of pieces and counts a task remembers, and characters of a piece that is remembered.
MEMO = 64 << 20
SHORT = 32

# Fixed value: the pattern of the byte-level tokenizer, which splits a text before merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def parts_of(text: str, size: int = PART) -> list[str]:
    """`text` in parts that end at the first safe boundary after `size` characters."""
    out, start = [], 0
    while len(text) - start > size:
        cut = SAFE.search(text, start + size)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    return [*out, text[start:]]


def batches(parts: list[str]) -> Iterator[list[str]]:
    """`parts` in order, in as few runs as BATCH bytes allow, which share the bytes equally but for longer parts."""
    sizes = [len(p.encode()) for p in parts]
    total = sum(sizes)
    share = total / max(1, -(-total // BATCH))
    start, given, made = 0, 0, 0
    for i, n in enumerate(sizes):
        if i > start and given + n / 2 > share * (made + 1):
            yield parts[start:i]
            start, made = i, made + 1
        given += n
    if start < len(parts):
        yield parts[start:]


class Tokens:
    """The tokenizer of a file: tokenizers for .json, sentencepiece for .model. Nothing is added or cut off."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task, as Spark counts cores
        self.byte_level, self.special = False, []
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
            self.count = lambda texts: list(map(len, self.encode(texts)))
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        encode = lambda texts: tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        self.encode = lambda texts: [e.ids for e in encode(texts)]
        self.count = lambda texts: list(map(len, encode(texts)))  # ids never become Python objects
        with open(path, encoding="utf-8") as f:
            self.said = json.load(f)
        first, added = self.said["pre_tokenizer"] or {}, self.said["added_tokens"]
        self.special = [t["content"] for t in added]
        # Else the tokenizer may look across what is a safe boundary here, and texts are not cut.
        self.byte_level = (
            self.said["normalizer"] is None
            and self.said["post_processor"] is None
            and first.get("type") == "ByteLevel"
            and first.get("use_regex", True)
            and not first.get("add_prefix_space")
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in added)
        )

    def lengths(self, texts: list[str | None]) -> list[int]:
        return [sum(parts) for parts in self.of(texts, self.count)]

    def of(self, texts: list[str | None], what: Callable[[list[str]], list] | None = None) -> Iterator[list]:
        """For every text the ids of its parts, or `what` is made of them; null and empty texts have none."""
        what = what or self.encode
        waiting: list[list[str]] = []
        size = 0
        for text in texts:
            waiting.append([] if not text else parts_of(text) if self.byte_level else [text])
            size += len(text or "")
            if size >= BATCH:
                yield from self.batch(waiting, what)
                waiting, size = [], 0
        yield from self.batch(waiting, what)

    def batch(self, texts: list[list[str]], what: Callable[[list[str]], list]) -> Iterator[list]:
        """The parts of some texts, encoded together."""
        made = [x for some in batches([p for t in texts for p in t]) for x in what(some)]
        at = 0
        for t in texts:
            yield made[at : at + len(t)]
            at += len(t)


class Lengths:
    """Token counts of texts by a byte-level tokenizer: batch encoding, of each piece once as long as it is remembered.

    A piece is a run of ASCII white space and the run of other characters after it: where it begins is a
    safe boundary, as no token reaches from a non-space character into the space that follows, and the
    pattern looks at nothing to the left. Short pieces repeat; those that came up in the current or last half of MEMO bytes
    are not encoded again. All others, and the parts of long ones, go to the tokenizer in batches of equal
    bytes, as do texts with other white space and all texts of other tokenizers.
    """

    def __init__(self, path: str):
        self.tokens = Tokens(path)
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.held = 0

    def of(self, texts: list[str | None]) -> list[int]:
        out = [0] * len(texts)
        if not self.tokens.byte_level:
            return self.tokens.lengths(texts)
        whole = [i for i, t in enumerate(texts) if t and WIDE.search(t)]
        for i, n in zip(whole, self.tokens.lengths([texts[i] for i in whole]), strict=True):
            out[i] = n
        apart = set(whole)
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for a, b in self.blocks(text) if text and i not in apart else ():
                waiting.append((i, PIECE.findall(text, a, b)))
                size += b - a
                if size >= BATCH:
                    self.add(waiting, out)
                    waiting, size = [], 0
        self.add(waiting, out)
        return out

    def blocks(self, text: str) -> Iterator[tuple[int, int]]:
        """Places that cut a text between pieces into blocks of about BATCH characters."""
        start = 0
        while start < len(text):
            stop = BOUNDARY.search(text, start + BATCH) if len(text) - start > BATCH else None
            end = stop.start() if stop else len(text)
            yield start, end
            start = end

    def add(self, waiting: list[tuple[int, list[str]]], out: list[int]) -> None:
        """Add the counts of the pieces of some blocks to those of their texts."""
        known = [list(map(self.recent.get, pieces)) for _, pieces in waiting]
        fresh = {p: self.older.get(p) for (_, pieces), ns in zip(waiting, known, strict=True) if None in ns for p, n in zip(pieces, ns, strict=True) if n is None}
        new = [p for p, n in fresh.items() if n is None]
        fresh.update(zip(new, self.tokens.lengths(new), strict=True))
        for (i, pieces), ns in zip(waiting, known, strict=True):
            out[i] += sum(fresh[p] if n is None else n for p, n in zip(pieces, ns, strict=True)) if None in ns else sum(ns)
        for p, n in fresh.items():
            if len(p) <= SHORT:
                if self.held > MEMO // 2:
                    self.recent, self.older, self.held = {}, self.recent, 0
                self.recent[p] = n
                self.held += 150 + len(p)  # a string and its place in the dictionary; counts are small numbers


class PlainIds:
    """Ids of texts as little-endian unsigned 32 bits, the same as those of `Tokens`, sooner.

    Where the merges of a byte-level file come in the order of the ids they make, another public encoder
    makes the same merges over the same vocabulary in a third of the time (tests hold it against `Tokens`). It
    takes the texts of PLAIN
    characters without a special string; the others, and other files, go to `Tokens`.
    """

    def __init__(self, path: str):
        self.tokens = Tokens(path)
        self.quick = None
        ranks = self.ranks() if self.tokens.byte_level else None
        if ranks:
            import tiktoken

            self.quick = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ranks(self) -> dict[bytes, int] | None:
        """Bytes of every entry of the vocabulary to its id; None if merges don't follow the ids."""
        model = self.tokens.said["model"]
        vocabulary, special = model["vocab"], set(self.tokens.special)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            return None
        made = [vocabulary[a + b] for a, b in merges]
        letters = {c: b for b, c in byte_letters().items()}
        known = {n: i for n, i in vocabulary.items() if n not in special}
        if any(x >= y for x, y in zip(made, made[1:], strict=False)) or set(made) | {vocabulary[c] for c in letters} != set(known.values()):
            return None
        if made and max(vocabulary[c] for c in letters) > made[0]:
            return None
        return {bytes(letters[c] for c in name): i for name, i in known.items()}

    def of(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = []
        for t in texts:
            if not t:
                out.append(b"")
            elif self.quick and PLAIN.fullmatch(t) and not any(s in t for s in self.tokens.special):
                out.append(b"".join(self.quick.encode_to_numpy(p, disallowed_special=()).astype("<u4").tobytes() for p in parts_of(t)))
            else:
                out.append(None)
        open_ = [i for i, ids in enumerate(out) if ids is None]
        for i, parts in zip(open_, self.tokens.of([texts[i] for i in open_]), strict=True):
            out[i] = b"".join(np.array(p, "<u4").tobytes() for p in parts)
        return out


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def token_length(path: str) -> Callable[[Column], Column]:
    """A column function: the number of tokens of a text by the tokenizer file at `path`."""

    @F.pandas_udf(LongType())
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Lengths(path)
        for texts in batches:
            yield pd.Series(counter.of(texts.tolist()), dtype="int64")

    return lengths.asNondeterministic()


def token_counts(df: DataFrame, path: str, limit: int, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """n_bytes, n_tokens and over_limit of every row, next to the columns `keep`.

    Null and empty texts have 0 bytes and 0 tokens. Other columns of the input are not read. Rows that
    repeat are counted each; an empty table gives an empty one.
    """
    small_batches(df.sparkSession)
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.select(
        *keep, F.octet_length(whole).cast("bigint").alias("n_bytes"), token_length(path)(whole).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > limit)
