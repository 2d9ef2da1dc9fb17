import random
import struct
import zlib
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from jouleloom.llm import packing, tokens
from jouleloom.llm.queries import REGISTRY, vocabulary
from jouleloom.session import written

ODD = [
    "", " ", "  ", "a  b", "x\n\n y ", "<|endoftext|>", "foo<|endoftext|> bar", "日本語 テキスト。 foo", "naïve café ²³ ½", "it's we'll I'M they've 'd",
    "tabs\t\tand\r\nlines \n", "emoji 😀 😀😀 ok", "привет мир", "\x1c\x1dfoo bar", "a  b", "x" * 5000, " \n a", "a \x85\n b", "12345 67 8,9.0 $%^",
    "a­b", "a　 b", "é" * 40_000, "word " * 20_000, "no_boundary" * 9_000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary())


def odd_texts():
    rng = random.Random(5)
    parts = ["a", "B", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "1", "é", "ß", "<|endoftext|>", " ", "日", "😀", "#", "\r", "-", "ж", "²", "\x0b", "\x1f", " ", "a b"]
    return ODD + ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(3000)]


def test_parts_and_plain_ids_equal_the_library(library):
    texts = odd_texts()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [[i for p in parts for i in p] for parts in tokens.Tokens(vocabulary()).of(texts)] == want
    counter = tokens.Lengths(vocabulary())
    assert counter.of(texts) == counter.of(texts) == [len(ids) for ids in want]
    quick = tokens.PlainIds(vocabulary())
    assert quick.quick is not None
    assert [list(struct.unpack(f"<{len(b) // 4}I", b)) for b in quick.of(texts)] == want


def test_counts_do_not_depend_on_blocks_and_memo(library, monkeypatch):
    monkeypatch.setattr(tokens, "BATCH", 50)
    monkeypatch.setattr(tokens, "MEMO", 20)
    texts = odd_texts()[:1500] + ["Many words, and\n\nlines  of them. " * 50]
    assert tokens.Lengths(vocabulary()).of(texts) == [len(e) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_batches_share_the_bytes():
    rng = random.Random(3)
    parts = [rng.choice("aé日") * rng.randint(1, 3000) for _ in range(2000)]
    got = list(tokens.batches(parts))
    sizes = [sum(len(p.encode()) for p in b) for b in got]
    assert [p for b in got for p in b] == parts and len(got) == -(-sum(sizes) // tokens.BATCH)
    assert max(sizes) - min(sizes) <= 2 * 9000 and max(sizes) <= tokens.BATCH + 9000
    assert list(tokens.batches([])) == [] and list(tokens.batches(["x" * 10**6, "y"])) == [["x" * 10**6], ["y"]]


def test_memory_is_bounded_by_bytes(library, monkeypatch):
    """Text without white space is cut at its punctuation, and what is remembered stays within its bytes."""
    monkeypatch.setattr(tokens, "MEMO", 300_000)
    rng = random.Random(4)
    signs = [chr(c) for c in range(0x4E00, 0x5600)]
    paragraphs = ["".join(rng.choices(signs, k=rng.randint(5, 40))) + rng.choice("。，！") for _ in range(3000)]
    text, counter = "".join(paragraphs), tokens.Lengths(vocabulary())
    parts = tokens.parts_of(text, 1000)
    assert "".join(parts) == text and max(map(len, parts)) < 1100
    want = len(library.encode(text, add_special_tokens=False))
    words = [" ".join(f"{rng.choice(signs)}{rng.randint(0, 10**9)}" for _ in range(400)) for _ in range(60)]
    assert counter.of([text, None, *words]) == [want, 0, *(len(e) for e in library.encode_batch(words, add_special_tokens=False))]
    for memo in (counter.recent, counter.older):
        assert memo and sum(150 + len(p) for p in memo) < 300_000 and max(map(len, memo)) <= tokens.SHORT


def test_long_texts_are_cut_where_it_is_safe():
    text = "word and, word\n" * 10_000
    parts = tokens.parts_of(text, 1000)
    assert "".join(parts) == text and len(parts) > 50 and all(p[0] == " " for p in parts[1:])


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_tokenizers(name):
    import public_tokenizers

    path, text = public_tokenizers.path(name), "Hello  World, what a day\n" * 3
    if name.endswith(".model"):
        import sentencepiece

        want = sentencepiece.SentencePieceProcessor(model_file=path).encode(text)
    else:
        want = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert next(tokens.Tokens(path).of([text])) == [want] and tokens.Lengths(path).of([None, text]) == [0, len(want)]
    assert tokens.PlainIds(path).of([text, None]) == [struct.pack(f"<{len(want)}I", *want), b""]


def test_counts_query(spark, sf, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in REGISTRY["op6_token_counts"](spark, sf).collect():
        n = len(library.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 512)


def test_counts_of_nulls_repeats_clashes_and_no_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", 5), (2, "hello", 5)], "doc_id bigint, text string, n_tokens int")
    rows = tokens.token_counts(df, vocabulary(), 0).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == [(0, 0, 0, False), (1, 0, 0, False), (1, 0, 0, False), (2, 5, 1, True)]
    assert tokens.token_counts(df.limit(0), vocabulary(), 1).count() == 0


@pytest.mark.parametrize("capacity", [64, 100, 1024])
def test_cuts_cover_documents(capacity):
    for n in [*range(1, 3 * capacity, 7), capacity, 2 * capacity]:
        pieces = packing.cuts(n, capacity)
        assert [s for s, _ in pieces] == [sum(x for _, x in pieces[:i]) for i in range(len(pieces))]
        assert sum(x for _, x in pieces) == n and all(0 < x <= capacity for _, x in pieces)


@pytest.mark.parametrize("capacity", [64, 100, 1024])
def test_sequences_of_pieces_of_one_length_have_little_padding(capacity):
    for n in range(1, capacity + 1):
        for _, piece in packing.cuts(n, capacity):
            k = capacity // piece  # a reciprocal is rounded down, by less than a token for each of k pieces
            assert capacity - k * piece <= max(capacity // packing.SLACK, k)


@pytest.mark.parametrize("sizes", [(3,), (5,), (8,), (3, 15), (94,), (500, 700)])
def test_short_texts_leave_little_padding(spark, sizes):
    """Pieces of many documents of few tokens: next to no padding but in the last sequences."""
    rows = [(i, s, length) for i in range(60_000) for s, length in packing.cuts(sizes[i % len(sizes)], 1024)]
    df = spark.createDataFrame(rows, "doc_id bigint, start bigint, length bigint").selectExpr("*", "0L AS ids_crc32", "0L AS doc_tokens")
    packed = packing.harmonic(written(df, "pieces"), 1024)
    bins = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["used"] == r["end"] <= 1024 for r in bins) and sum(r["used"] for r in bins) == sum(r[2] for r in rows)
    assert sorted(r["sequence_id"] for r in bins) == list(range(len(bins)))
    assert 1 - sum(r["used"] for r in bins) / (1024 * len(bins)) < 0.03


def test_what_is_left_over_is_bounded():
    assert packing.most_left(1024) < 6 * 1024 and len({1024 // n for n in range(1, 1025)}) <= 64
    left = pd.DataFrame([(i, n, 0) for n in range(1, 1025) for i in range(1024 // n - 1)][:: 7], columns=["doc_id", "length", "start"])
    placed = packing.best_fit(left, 1024, ["doc_id", "start", "length"])
    used = placed.groupby("sequence_id")["length"].sum()
    assert used.max() <= 1024 and (placed["offset"] + placed["length"]).max() <= 1024


def check_packing(rows, ids, capacity):
    """Every id in exactly one piece, sequences without gaps and within capacity; the part that is padding."""
    bins, cover = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        part = own[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(own) and zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        cover[r["doc_id"]].append((r["start"], r["length"]))
    for pieces, whole in [(v, None) for v in bins.values()] + [(cover[d], len(ids[d])) for d in ids]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at <= capacity if whole is None else at == whole
    assert sorted(bins) == list(range(len(bins)))
    used = sum(length for v in bins.values() for _, length in v)
    return 1 - used / (len(bins) * capacity)


def test_packing_query(spark, sf, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t in docs.items()}
    assert check_packing(REGISTRY["op4_harmonic_packing"](spark, sf).collect(), ids, 1024) < 0.03


def test_packing_of_nulls_long_texts_clashes_and_no_rows(spark, library):
    texts = {1: None, 2: "", 3: "a b c " * 3000, 4: "x", 5: "x", 6: "the end of it " * 9}
    df = spark.createDataFrame([(d, t, "z") for d, t in texts.items()], "doc_id bigint, text string, class string")
    packed = packing.pack(df, vocabulary(), capacity=128, with_ids=True)
    ids = {d: [*library.encode(t or "", add_special_tokens=False).ids, 0] for d, t in texts.items()}
    check_packing(packed.collect(), ids, 128)
    assert sum(r["n_tokens"] for r in packing.sequences(packed).collect()) == sum(map(len, ids.values()))
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * r["n_tokens"] <= 512
    assert packing.pack(df.limit(0), vocabulary()).count() == 0
    twice = packing.pack(df.where("doc_id = 4").union(df.where("doc_id = 4")), vocabulary()).collect()
    assert sorted(r["offset"] for r in twice) == [0, 2] and len({r["sequence_id"] for r in twice}) == 1
