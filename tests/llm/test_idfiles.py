import random
import struct
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from jouleloom.llm import idfiles
from jouleloom.llm.queries import REGISTRY
from tests.llm.test_tokens import odd_texts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(docs=st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), min_size=1, max_size=20), min_size=1, max_size=10))
def test_ranks_come_back(docs):
    counts = np.array([len(d) for d in docs])
    ranks = np.array([r for d in docs for r in d], np.uint32)
    control, data, controls, sizes = idfiles.encode_ranks(ranks, counts)
    assert controls.tolist() == [-(-len(d) // 4) for d in docs]
    assert sizes.tolist() == [sum(max(1, (r.bit_length() + 7) // 8) for r in d) for d in docs]
    assert idfiles.decode_ranks(control, data, counts).tolist() == ranks.tolist()


def test_block_layout_and_damage():
    control, data, _, _ = idfiles.encode_ranks(np.array([1, 256, 70000, 2**24, 5], np.uint32), np.array([5]))
    assert control == bytes([0b11100100, 0]) and data == b"\x01\x00\x01\x70\x11\x01\x00\x00\x00\x01\x05"
    block = idfiles.pack_block(3, 16, [(None, 12, 9, 4, 5)], [control], [data]) + b"\n"
    assert struct.unpack_from(">4siq", block) == (b"FRB1", 3, 16)
    block += struct.pack(">4siq", b"FRBE", 3, 21) + b"\n"
    ((lists, c, d),) = idfiles.blocks_of(block)
    assert (c, d) == (control, data) and {k: v.tolist() for k, v in lists.items()} == {"id": [0], "null": [1], "start": [12], "total": [9], "before": [4], "here": [5]}
    with pytest.raises(ValueError, match="damaged"):
        list(idfiles.blocks_of(block[:-30] + b"\xff" + block[-29:]))


@pytest.mark.parametrize("batch", [1 << 18, 60])
def test_ids_equal_the_library(library, monkeypatch, batch):
    monkeypatch.setattr(idfiles, "BATCH", batch)
    rng = random.Random(8)
    parts = ["a", "Be", "word", " ", "  ", "\n", ".", ",", "...", "'", "'s", "'LL", "l'eau", "12", "½", "é", "Ñ", "ß", "ж", "Щ", "\x0b", "€", "µ", "_", "\xad", "--", "Ð", "ĳ", "ŉ", "ſ"]
    texts = odd_texts() + ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["ΟΔΟΣ ΑΣ. Σ", "İ ß", "a ́b", "'s 's't", "word, " * 60_000, "日本語。" * 9000, "x" * 30 + " <|ENDOFTEXT|>", "y" * 900 + " z", " ", "\x00\x01 a"]
    vocabulary = idfiles.Vocabulary(PATH)
    encoder = idfiles.Encoder(vocabulary)
    assert vocabulary.apart and encoder.quick is not None and encoder.of(None) == b""
    ids = lambda raw: np.frombuffer(raw, "<u4").tolist()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids(encoder.of(text)) == want.ids, text[:80]


@pytest.mark.parametrize("together", [1 << 21, 50])
def test_a_word_of_many_texts_is_merged_once(library, monkeypatch, together):
    monkeypatch.setattr(idfiles, "TOGETHER", together)
    encoder = idfiles.Encoder(idfiles.Vocabulary(PATH))
    given, quick = [], encoder.quick

    class Counted:
        def encode_to_numpy(self, text, **options):
            given.append(text)
            return quick.encode_to_numpy(text, **options)

    encoder.quick = Counted()
    texts = ["Erretihe, l'eau it's 12", None, "", " \n", "日本語 erretihe", "z" * 401 + " erretihe", "é" * 201 + " a", *["erretihe it's 12 " * 9] * 200, "erretihe <|endoftext|>"]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.batch(texts)] == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    if together > 50:
        assert sorted(" ".join(given).split()) == sorted(["erretihe", ",", "l", "'", "eau", "it", "'s", "1", "2"])
    assert encoder.batch([]) == []


def test_all_words_of_the_corpus_equal_the_library(library, spark):
    docs = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    encoder = idfiles.Encoder(idfiles.Vocabulary(PATH))
    assert all(np.frombuffer(encoder.of(t), "<u4").tolist() == e.ids for t, e in zip(docs, library.encode_batch(docs, add_special_tokens=False), strict=True))


def test_merges_that_differ_by_encoder_are_left_to_the_library():
    """(a, bc) gives abc; merged by bytes alone, ab and c would give it, too."""
    letters = idfiles.byte_letters()
    single = [letters[b] for b in range(256)]
    names = single + [c + "</w>" for c in single] + ["ab", "bc", "abc"]
    good = {"type": "BPE", "end_of_word_suffix": "</w>", "vocab": {n: i for i, n in enumerate(names)}, "merges": [["b", "c"], ["a", "bc"], ["a", "b"]]}
    assert idfiles.Vocabulary.merge_ranks(good)[0] is not None
    assert idfiles.Vocabulary.merge_ranks(good | {"merges": [["a", "b"], ["b", "c"], ["a", "bc"]]}) == (None, None)


def test_files_of_other_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary = idfiles.Vocabulary(path)
    text = "Two  spaces,\n\nand lines"
    assert not vocabulary.apart and np.frombuffer(idfiles.Encoder(vocabulary).of(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text).ids


def plain(docs, library, end):
    out, at = [], 0
    for d, t in docs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, end]
        out.append((d, at, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out


def test_query_gives_what_the_library_gives(spark, sf, library):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    got = REGISTRY["op12_id_files"](spark, sf)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == plain(docs, library, 2)


@pytest.mark.parametrize("block,row", [(1 << 18, 1 << 16), (40, 7)])
def test_files_hold_nulls_long_texts_repeats_and_clashes(spark, library, tmp_path, monkeypatch, block, row):
    monkeypatch.setattr(idfiles, "BLOCK_TOKENS", block)
    monkeypatch.setattr(idfiles, "ROW_TOKENS", row)
    rng = random.Random(3)
    texts = [None, "", "a b c " * 300, *(" ".join(rng.choices(["alpha", "beta,", "Γ", "日本", "12"], k=rng.randint(1, 30))) for _ in range(60))]
    rows = [(i * 7 % 61 - 5, t, "z") for i, t in enumerate(texts)] + [(None, "no name", "z"), (3, "twice", "z"), (3, "twice", "z")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    idfiles.write_ids(df, PATH, str(tmp_path / "ids"), end_id=2)
    pieces = idfiles.read_ids(spark, str(tmp_path / "ids"))
    back = {}
    for r in pieces.collect():
        back.setdefault((r["id"], r["start"], r["total"]), []).append((r["before"], bytes(r["ids"])))
    joined = sorted(((i, s, n, b"".join(x for _, x in sorted(p))) for (i, s, n), p in back.items()), key=lambda r: r[1])
    assert len(joined) == len(rows) and [r[0] for r in joined] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at = 0
    for _, start, n, ids in joined:
        assert (start, 4 * n) == (at, len(ids))
        at += n
    want = sorted(((d is not None, d or 0), struct.pack(f"<{len(x)}I", *x)) for d, t, _ in rows for x in [[*library.encode(t or "", add_special_tokens=False).ids, 2]])
    assert sorted(((i is not None, i or 0), ids) for i, _, _, ids in joined) == want
    assert sorted(map(str, idfiles.document_digests(idfiles.read_digests(spark, str(tmp_path / "ids"))).collect())) == sorted(str(type(r)(id=r.id, start=r.start, n_tokens=r.n_tokens, ids_crc32=r.ids_crc32)) for r in digests(spark, joined))
    # Files in the order of their names hold the blocks in ascending order.
    names = [(0 if n else -1, i) for f in sorted((tmp_path / "ids/blocks").glob("part-*")) for of, _, _ in idfiles.blocks_of(f.read_bytes()) for n, i in zip(1 - of["null"], of["id"], strict=True)]
    assert names == sorted(names) and len(names) >= len(rows)


def digests(spark, joined):
    return spark.createDataFrame([(i, s, n, zlib.crc32(ids)) for i, s, n, ids in joined], "id bigint, start bigint, n_tokens bigint, ids_crc32 bigint").collect()


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    idfiles.write_ids(df, PATH, str(tmp_path / "ids"), end_id=2)
    assert idfiles.document_digests(idfiles.read_digests(spark, str(tmp_path / "ids"))).count() == 0 == idfiles.read_ids(spark, str(tmp_path / "ids")).count()
