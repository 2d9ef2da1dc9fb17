"""Token ids of a corpus in binary files: frequency-ranked, byte-aligned, lengths apart from data.

Ids are replaced by their rank in the corpus, the most frequent first, so that most take one byte. A rank takes
one to four bytes, little-endian without leading zeros; the lengths of four ranks, two bits each, make one
control byte, and all control bytes of a block come before its data bytes. A reader looks up the four lengths
of a control byte in a table and so finds where each rank begins without looking at the data.

A folder holds `ranks` (the ids in the order of their ranks) and `blocks`, files of blocks in ascending order of
document ids. Blocks belong to parts, which are numbered in that order; the last block of a part is followed by
the number of its tokens. The header of a block is big-endian, the lists are little-endian:

    magic "FRB1", int32 part, int64 first token in the part, int64 documents n, int64 control bytes, int64 data bytes
    per document: int64[n] ids, uint8[n] whether the id is null, int64[n] first token in the part (a document that
        goes on from another block began there), int64[n] tokens of the whole document, int64[n] tokens before
        those in this block, int64[n] tokens here
    control bytes: four ranks each; every document begins a new one
    data bytes
    uint32 CRC-32 of all of the above, line feed

    after a part: magic "FRBE", int32 part, int64 tokens, line feed
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jouleloom.llm.common import small_batches
from jouleloom.llm.tokens import SAFE, byte_letters
from jouleloom.session import written

#: Tokens in one row, about; tokens of a block, after which it is closed; blocks in a file at most.
ROW_TOKENS = 1 << 16
BLOCK_TOKENS = 1 << 18
FILE_BLOCKS = 64
#: Tokens that are coded at once, which bounds the memory, and rows from which the parts are found.
GROUP_TOKENS = 1 << 19
SAMPLE = 100_000

MAGIC, PART_END = b"FRB1", b"FRBE"
HEAD, TAIL = ">4siqqqq", ">4siq"
HEAD_SIZE, TAIL_SIZE = struct.calcsize(HEAD), struct.calcsize(TAIL)
END = b"\n"

#: Ranks up to which a number of bytes reaches, and the four lengths of every control byte.
LIMITS = np.array([1 << 8, 1 << 16, 1 << 24], np.uint32)
CONTROL_LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)
#: What of four bytes belongs to a rank of that length.
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)

# A normalizer and a splitter that drop white space, so that it never matters to what stands beside it,
# and the mark of a word's end.
SPLITS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_END = "</w>"

# White space, letters, numbers and other characters that all versions of Unicode and both lower-casings treat
# alike: ASCII, Latin-1, Latin Extended-A without the dotted capital I, and Cyrillic.
SPACES, LETTERS, NUMBERS = "\t-\r ", "A-Za-zªµºÀ-ÖØ-öø-įı-žЀ-џ", "0-9²³¹¼½¾"
OTHERS = "!-/:-@\\[-`{-~¡-©«-±´¶-¸»¿×÷"
PLAIN = re.compile(f"[{SPACES}{LETTERS}{NUMBERS}{OTHERS}]*")
#: SPLITS for texts of PLAIN characters in lower case.
WORD = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[{OTHERS}]+")
#: Texts with a word of more bytes are left to the library.
LONG = 400
#: Characters in a batch for the library, and of texts whose words are merged together.
BATCH = 1 << 18
TOGETHER = 1 << 21


class Vocabulary:
    """A file of the library `tokenizers`, and whether words can be merged outside of it.

    Texts can be cut at white space if the file drops it, by NORMALIZERS and SPLITS. The library merges the pair of symbols
    whose merge stands first; another public encoder merges the pair whose bytes together have the lowest rank. With
    ranks in the order of merges both do the same if each entry, cut by the merges before its own alone, comes
    to the two symbols of its own merge: then no other two symbols that make it up ever stand beside each other when
    its turn comes. `ranks` is None if that does not hold for every entry.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        first = ((said["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        added = said["added_tokens"]
        self.special = [t["content"] for t in added]
        self.apart = (
            (said["normalizer"] or {}).get("normalizers") == NORMALIZERS
            and first.get("pattern") == {"Regex": SPLITS}
            and (first.get("behavior"), first.get("invert")) == ("Removed", True)
            and said["post_processor"] is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"] for t in added)
        )
        model = said["model"]
        self.size = max([*model.get("vocab", {"": 0}).values(), *(t["id"] for t in added)]) + 1
        self.ranks, self.ids = self.merge_ranks(model) if self.apart else (None, None)

    @staticmethod
    def merge_ranks(model: dict) -> tuple[dict[bytes, int] | None, np.ndarray | None]:
        """Bytes of every entry to a rank in the order of merges, and the id of every rank; a space marks a word's end."""
        if model.get("type") != "BPE" or model.get("end_of_word_suffix") != WORD_END or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "ignore_merges", "byte_fallback")
        ):
            return None, None
        vocabulary = model["vocab"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        letters = byte_letters()
        single = [letters[b] for b in range(256)]
        # Ends of words are merged first, as the library begins with them.
        order = [c + WORD_END for c in single] + single + [a + b for a, b in merges]
        if len(set(order)) != len(order) or not set(order) <= set(vocabulary):
            return None, None
        place = {m: i for i, m in enumerate(merges)}
        if any(cut_by(a + b, place, i) != [a, b] for i, (a, b) in enumerate(merges)):
            return None, None
        byte_of = {c: b for b, c in letters.items()}

        def raw(name: str) -> bytes:
            stem = name.removesuffix(WORD_END)
            return bytes(byte_of[c] for c in stem) + (b" " if name != stem else b"")

        return {raw(name): i for i, name in enumerate(order)}, np.array([vocabulary[n] for n in order], np.uint32)


def cut_by(name: str, place: dict[tuple[str, str], int], below: int) -> list[str]:
    """The symbols of an entry after all merges that stand before `below`."""
    stem = name.removesuffix(WORD_END)
    parts = list(stem)
    if name != stem:
        parts[-1] += WORD_END
    while len(parts) > 1:
        at = [place.get(pair, below) for pair in zip(parts, parts[1:], strict=False)]
        least = min(at)
        if least >= below:
            break
        i = at.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Encoder:
    """Ids of texts by a vocabulary (little-endian unsigned 32 bits), nothing added.

    Words of texts of PLAIN characters are merged by the other encoder where that does the same, each different word of
    about TOGETHER characters once. Other texts are cut at
    spaces between letters and go to the library in batches of about BATCH characters, as do all texts, uncut, of files that
    don't drop white space.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.known = vocabulary
        self.tokenizer = None
        self.quick = None
        if vocabulary.ranks:
            import tiktoken

            self.quick = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=vocabulary.ranks, special_tokens={})
            self.ends = np.zeros(len(vocabulary.ids), bool)  # whether a rank ends a word
            self.ends[[i for name, i in vocabulary.ranks.items() if name.endswith(b" ")]] = True

    def library(self, parts: list[str]) -> bytes:
        """The ids of parts one after the other, encoded in batches of about BATCH characters."""
        if self.tokenizer is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per task, as Spark counts cores
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.known.path)
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
        out = []
        start = 0
        while start < len(parts):
            end, size = start, 0
            while end < len(parts) and (size == 0 or size + len(parts[end]) <= BATCH):
                size += len(parts[end])
                end += 1
            out += [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(parts[start:end], add_special_tokens=False)]
            start = end
        return b"".join(out)

    def of(self, text: str | None) -> bytes:
        return self.batch([text])[0]

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text."""
        found: dict[int, list[bytes] | None] = {}
        waiting, size = [], 0
        for i, text in enumerate(texts):
            if text and self.quick and PLAIN.fullmatch(text) and not any(s in text for s in self.known.special):
                found[i] = []
                for part in cut(text, BATCH, SPACE):
                    waiting.append((i, part))
                    size += len(part)
                    if size >= TOGETHER:
                        self.merge(waiting, found)
                        waiting, size = [], 0
        self.merge(waiting, found)
        out = []
        for i, text in enumerate(texts):
            own = found.get(i)
            if own is not None or not text:
                out.append(b"".join(own or []))
            else:
                out.append(self.library(list(cut(text, BATCH // 8, SAFE)) if self.known.apart else [text]))
        return out

    def merge(self, parts: list[tuple[int, str]], found: dict[int, list[bytes] | None]) -> None:
        """Add the ids of parts of texts to those of their texts; a text with a word longer than LONG gets None."""
        words = [WORD.findall(part.lower()) for _, part in parts]
        coded = pa.array(chain.from_iterable(words), pa.string()).dictionary_encode()
        names = coded.dictionary.to_pylist()
        if any(len(name) > LONG // 2 and len(name.encode()) > LONG for name in names):
            long = {i for (i, _), own in zip(parts, words, strict=True) if any(len(w.encode()) > LONG for w in own)}
            found.update(dict.fromkeys(long))
            return self.merge([p for p in parts if p[0] not in long], found)
        stops = np.zeros(1, np.int64)
        raw = b""
        if names:
            ranks = self.quick.encode_to_numpy(" ".join(names) + " ", disallowed_special=())
            upto = np.flatnonzero(self.ends[ranks]) + 1
            sizes = np.diff(upto, prepend=0)
            at = coded.indices.to_numpy()
            n = sizes[at]
            stops = np.concatenate([stops, np.cumsum(n)])
            raw = self.known.ids[ranks][np.arange(stops[-1]) + np.repeat((upto - sizes)[at] - stops[:-1], n)].astype("<u4").tobytes()
        last = (4 * stops[np.cumsum([0, *map(len, words)])]).tolist()
        for (i, _), start, stop in zip(parts, last, last[1:], strict=False):
            if found[i] is not None:
                found[i].append(raw[start:stop])


SPACE = re.compile(r"(?=[ \t-\r])")


def cut(text: str, size: int, where: re.Pattern) -> Iterator[str]:
    """`text` in parts that end at the first place `where` after `size` characters."""
    start = 0
    while len(text) - start > size:
        found = where.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes, np.ndarray, np.ndarray]:
    """Control and data bytes of the ranks of some documents one after the other, and how many each has of both.

    Every document has one rank at least.
    """
    widest = width(int(ranks.max(initial=0)))
    sizes = np.ones(len(ranks), np.uint8)
    for limit in LIMITS[: widest - 1]:
        sizes += ranks >= limit
    kept = np.ascontiguousarray(ranks, "<u2" if widest <= 2 else "<u4")
    data = kept.view(np.uint8).reshape(len(ranks), -1)
    data = data[np.arange(data.shape[1], dtype=np.uint8) < sizes[:, None]]
    controls = -(-counts // 4)
    slots = np.zeros(4 * int(controls.sum()), np.uint8)
    slots[slot_places(counts, controls)] = sizes - np.uint8(1)
    four = slots.reshape(-1, 4)
    joined = four[:, 0] | four[:, 1] << np.uint8(2) | four[:, 2] << np.uint8(4) | four[:, 3] << np.uint8(6)
    own = np.add.reduceat(sizes, np.cumsum(counts) - counts, dtype=np.int64) if len(counts) else counts
    return joined.tobytes(), data.tobytes(), controls, own


def width(rank: int) -> int:
    """Bytes that a rank takes."""
    return 1 + int((LIMITS <= rank).sum())


def slot_places(counts: np.ndarray, controls: np.ndarray) -> np.ndarray:
    """Where the ranks lie among the slots of the control bytes, four each; a document's last ones may be empty."""
    empty = 4 * controls - counts
    return np.arange(int(counts.sum())) + np.repeat(np.cumsum(empty) - empty, counts)


def decode_ranks(control: bytes, data: bytes, counts: np.ndarray) -> np.ndarray:
    """The ranks of all documents of a block: lengths by table, places by their sum, as many bytes as the longest, masked."""
    controls = -(-counts // 4)
    sizes = CONTROL_LENGTHS[np.frombuffer(control, np.uint8)].ravel()[slot_places(counts, controls)]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    ranks = raw[at].astype(np.uint32)
    for k in range(1, int(sizes.max(initial=1))):
        ranks |= raw[k:][at].astype(np.uint32) << np.uint32(8 * k)
    return ranks & MASKS[sizes]


def pack_block(part: int, first: int, docs: list[tuple], control: list[bytes], data: list[bytes]) -> bytes:
    """A block; `docs` are (id, first token, tokens in all, tokens before, tokens here)."""
    ids, starts, totals, before, here = zip(*docs, strict=True)
    lists = [np.array([i or 0 for i in ids], "<i8"), np.array([i is None for i in ids], np.uint8), *(np.array(x, "<i8") for x in (starts, totals, before, here))]
    sizes = len(docs), sum(map(len, control)), sum(map(len, data))
    block = b"".join([struct.pack(HEAD, MAGIC, part, first, *sizes), *(x.tobytes() for x in lists), *control, *data])
    return block + struct.pack("<I", zlib.crc32(block))


def blocks_of(content: bytes) -> Iterator[tuple[dict[str, np.ndarray], bytes, bytes]]:
    """(lists per document, control bytes, data bytes) of the blocks of a file; an error if one is damaged."""
    at = 0
    while at < len(content):
        if content[at : at + 4] == PART_END:
            at += TAIL_SIZE + len(END)
            continue
        magic, _, _, n, controls, size = struct.unpack_from(HEAD, content, at)
        stop = at + HEAD_SIZE + 41 * n + controls + size
        if magic != MAGIC or struct.unpack_from("<I", content, stop)[0] != zlib.crc32(memoryview(content)[at:stop]):
            raise ValueError(f"damaged block at byte {at}")
        place = at + HEAD_SIZE
        lists = {}
        for name, kind, width in (("id", "<i8", 8), ("null", "u1", 1), ("start", "<i8", 8), ("total", "<i8", 8), ("before", "<i8", 8), ("here", "<i8", 8)):
            lists[name] = np.frombuffer(content, kind, n, place)
            place += width * n
        yield lists, content[place : place + controls], content[place + controls : stop]
        at = stop + 4 + len(END)


TOKEN_ROWS = "id bigint, hash bigint, mark bigint, part int, piece bigint, n bigint, total bigint, ids binary"


def token_rows(df: DataFrame, vocabulary: Vocabulary, end_id: int, bounds: list[tuple]) -> DataFrame:
    """TOKEN_ROWS: the tokens of every row of `keyed`, in pieces of ROW_TOKENS at most, and a row of counts of each task.

    Ids take two bytes if all of the vocabulary do. Rows of counts have piece -1 and, as ids, those that occur and how
    often, as long integers.
    """
    kind = id_type(vocabulary, end_id)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        total = np.zeros(max(vocabulary.size, end_id + 1), np.int64)
        last = end_id.to_bytes(4, "little")
        for b in batches:
            found = encoder.batch(b["text"].tolist())
            ids = np.frombuffer(b"".join(x for own in found for x in (own, last)), "<u4")
            total += np.bincount(ids, minlength=len(total))
            raw = ids.astype(kind).tobytes()
            width, at, out = np.dtype(kind).itemsize, 0, []
            for i, h, mark, own in zip(b["id"], b["hash"], b["mark"], found, strict=True):
                part = bisect_right(bounds, (False, 0, h, mark) if pd.isna(i) else (True, int(i), h, mark))
                n = len(own) // 4 + 1
                for k in range(0, n, ROW_TOKENS):
                    stop = min(k + ROW_TOKENS, n)
                    out.append((i, h, mark, part, k // ROW_TOKENS, stop - k, n, raw[width * (at + k) : width * (at + stop)]))
                at += n
            made = pd.DataFrame(out, columns=[c.split()[0] for c in TOKEN_ROWS.split(", ")])
            yield made.astype({"id": "Int64"})
        some = np.flatnonzero(total)
        if len(some):
            yield pd.DataFrame({"id": pd.array([pd.NA], "Int64"), "hash": 0, "mark": -1, "part": -1, "piece": -1, "n": 0, "total": 0, "ids": [np.stack([some, total[some]]).astype("<i8").tobytes()]})

    return df.mapInPandas(encode, TOKEN_ROWS)


def keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, hash, mark, text): rows of one id come in the order of a hash of their text; rows that agree in both are
    told apart by their place."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.col(id_column).cast("bigint").alias("id"), F.xxhash64(whole).alias("hash"), F.monotonically_increasing_id().alias("mark"), whole.alias("text"))


def id_type(vocabulary: Vocabulary, end_id: int) -> str:
    return "<u2" if max(vocabulary.size, end_id + 1) <= 1 << 16 else "<u4"


def frequency_ranks(rows: DataFrame) -> np.ndarray:
    """The ids that occur, the most frequent first, of equal ones the smaller; from the rows of counts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for told in b["ids"]:
                ids, n = np.frombuffer(told, "<i8").reshape(2, -1)
                yield pd.DataFrame({"id": ids, "n": n})

    counted = rows.where("piece = -1").select("ids").mapInPandas(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    found = counted.toPandas()  # one row an id of the vocabulary
    return found.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)


def part_bounds(rows: DataFrame, count: int, least: int) -> list[tuple]:
    """Keys that cut the rows into parts of about FILE_BLOCKS full blocks, or into `least` smaller ones.

    They come from a sample of SAMPLE rows, which bounds what the driver gets and so the number of parts; rows of
    one id are cut by the hash of their text and their place. Null ids come first. Tokens are reckoned by bytes.
    """
    share = min(1.0, SAMPLE / max(count, 1))
    some = rows if share == 1 else rows.sample(share, seed=1)
    keys = some.select(F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), "hash", "mark", (F.octet_length("text") / 2 + 1).alias("n"))
    drawn = sorted(map(tuple, keys.collect()))
    upto = np.cumsum([k[-1] for k in drawn])
    total = upto[-1] / share if len(drawn) else 0
    parts = int(max(total // (FILE_BLOCKS * BLOCK_TOKENS) + 1, min(least, total // BLOCK_TOKENS)))
    parts = min(parts, len(drawn) // 8 + 1)
    at = np.searchsorted(upto, [upto[-1] * i / parts for i in range(1, parts)]) if parts > 1 else []
    return sorted({drawn[i][:-1] for i in at})


def write_ids(df: DataFrame, path: str, folder: str, end_id: int, id_column: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all texts, each with `end_id` after it, to `folder` in ascending order of the ids of the rows.

    Null ids come first; rows of one id are in the order of a hash of their text. Null and empty texts are the end
    id alone, rows that repeat are written each, and an empty table gives a folder without blocks. Ids are whole
    numbers. Other columns are not read. Files are written by Spark, none of more than FILE_BLOCKS blocks.
    """
    spark = df.sparkSession
    small_batches(spark)
    vocabulary = Vocabulary(path)
    kind = id_type(vocabulary, end_id)
    given = keyed(df, id_column, text)
    bounds = part_bounds(given, df.count(), spark.sparkContext.defaultParallelism)
    rows = written(token_rows(given, vocabulary, end_id, bounds), "ids-rows", "zstd")
    ranked = frequency_ranks(rows)

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = np.zeros(int(ranked.max(initial=0)) + 1, np.uint32)
        rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
        docs, control, data, held, at, part = [], [], [], 0, 0, None
        for whole in batches:
            for _, b in whole.groupby(whole["n"].cumsum() // GROUP_TOKENS):
                counts = b["n"].to_numpy(np.int64)
                controls, datas, of_control, of_data = encode_ranks(rank[np.frombuffer(b"".join(b["ids"]), kind)], counts)
                c, d = 0, 0
                for i, piece, n, total, part, more_c, more_d in zip(b["id"], b["piece"], b["n"], b["total"], b["part"], of_control.tolist(), of_data.tolist(), strict=True):
                    before = piece * ROW_TOKENS
                    docs.append((None if pd.isna(i) else int(i), at - before, total, before, n))
                    control.append(controls[c : c + more_c])
                    data.append(datas[d : d + more_d])
                    c, d, held, at = c + more_c, d + more_d, held + n, at + n
                    if held >= BLOCK_TOKENS:
                        yield pd.DataFrame({"block": [pack_block(part, at - held, docs, control, data)]})
                        docs, control, data, held = [], [], [], 0
        last = [pack_block(part, at - held, docs, control, data)] if docs else []
        if part is not None:
            yield pd.DataFrame({"block": [*last, struct.pack(TAIL, PART_END, part, at)]})

    placed = rows.where("piece >= 0").repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("id", "hash", "mark", "piece")
    blocks = placed.select("id", "part", "piece", "n", "total", "ids").mapInPandas(build, "block binary")
    # A text of bytes is written as it is; the line feed after it belongs to the format.
    as_text = blocks.select(F.col("block").cast("string").alias("value")).write.option("lineSep", END.decode()).option("compression", "none")
    as_text.option("maxRecordsPerFile", FILE_BLOCKS).text(f"{folder}/blocks")
    ids = spark.createDataFrame([(ranked.astype("<u4").tobytes(),)], "value binary").select(F.col("value").cast("string"))
    ids.coalesce(1).write.option("lineSep", END.decode()).option("compression", "none").text(f"{folder}/ranks")


def rank_file(spark: SparkSession, folder: str) -> np.ndarray:
    """The ids in the order of their ranks, one row of a few bytes an id of the vocabulary."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/ranks").select("content").collect()
    return np.frombuffer(b"".join(bytes(r["content"])[: -len(END)] for r in found), "<u4")


def big_endian(content: str, at: int, size: int) -> Column:
    """The whole number in `size` bytes of a binary column from byte `at` (from 1, or from the end if negative)."""
    return F.conv(F.hex(F.substring(content, at, size)), 16, 10).cast("bigint")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, total, before, ids): what each block holds of each document; ids are little-endian 32 bits.

    `before` is 0 and the ids are `total` for all but documents that reach over several blocks.
    """
    return decoded(spark, folder, lambda parts: {"ids": parts}, "ids binary")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As `read_ids`, but of the ids only how many they are and their CRC-32: n and crc."""
    return decoded(spark, folder, lambda parts: {"n": [len(p) // 4 for p in parts], "crc": [zlib.crc32(p) for p in parts]}, "n bigint, crc bigint")


def decoded(spark: SparkSession, folder: str, of_parts: Callable[[list[bytes]], dict[str, list]], columns: str) -> DataFrame:
    """(id, start, total, before) and `columns`, which are made of the ids that a block has of each document."""
    ids = rank_file(spark, folder)
    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/blocks").select("content").where(F.length("content") > 0)
    tail = TAIL_SIZE + len(END)
    ends = files.where(F.substring("content", -tail, 4) == F.lit(PART_END)).select(big_endian("content", 4 - tail, 4).alias("part"), big_endian("content", 8 - tail, 8).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    bases = written(ends.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "ids-bases")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content, base in zip(b["content"], b["base"], strict=True):
                for of, control, data in blocks_of(content):
                    raw = ids[decode_ranks(control, data, of["here"])].astype("<u4").tobytes()
                    stops = 4 * np.cumsum(of["here"])
                    parts = [raw[e - 4 * n : e] for n, e in zip(of["here"], stops, strict=True)]
                    names = pd.array(of["id"], dtype="Int64")
                    names[of["null"] == 1] = pd.NA
                    yield pd.DataFrame({"id": names, "start": of["start"] + base, "total": of["total"], "before": of["before"], **of_parts(parts)})

    numbered = files.withColumn("part", big_endian("content", 5, 4)).join(bases, "part")
    return numbered.select("content", "base").mapInPandas(decode, f"id bigint, start bigint, total bigint, before bigint, {columns}")


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The CRC-32 of parts one after the other, from (bytes, CRC-32) of each: that of the part before passes as
    many zero bytes as the part has."""
    out = 0
    for n, crc in parts:
        out = zlib.crc32(bytes(n), out ^ 0xFFFFFFFF) ^ 0xFFFFFFFF ^ crc
    return out


def document_digests(pieces: DataFrame) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from `read_digests`.

    Documents in one block need no shuffle; of the others only lengths and CRCs meet.
    """
    told = written(pieces, "ids-digests")
    one = told.where("n = total").select("id", "start", F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
    several = told.where("n < total").groupBy("id", "start").agg(F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("before", "n", "crc"))).alias("parts"))

    @F.pandas_udf("bigint")
    def combine(parts: pd.Series) -> pd.Series:
        return pd.Series([joined_crc([(4 * p["n"], p["crc"]) for p in of]) for of in parts], dtype="int64")

    return one.union(several.select("id", "start", "n_tokens", combine("parts").alias("ids_crc32")))
