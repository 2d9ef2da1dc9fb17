import hashlib
import math
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jouleloom.llm import resample


@settings(max_examples=60, deadline=None)
@given(data=st.binary(min_size=1, max_size=3000), picks=st.lists(st.tuples(st.integers(0, 2999), st.integers(1, 3000)), min_size=1, max_size=8))
def test_crcs_of_spans_are_those_of_their_bytes(data, picks):
    spans = [(s % len(data), min(n, len(data) - s % len(data))) for s, n in picks]
    starts, sizes = (np.array(x, np.int64) for x in zip(*spans, strict=True))
    assert resample.span_crcs(np.frombuffer(data, np.uint8), starts, sizes).tolist() == [zlib.crc32(data[s : s + n]) for s, n in spans]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 511, 512, 513, 100_003])
def test_long_spans(n):
    data = np.random.default_rng(n).integers(0, 256, n, np.uint8)
    assert resample.span_crcs(data, np.array([0]), np.array([n])).tolist() == [zlib.crc32(data.tobytes())]


def plain_features(text):
    found = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    cut = "".join(c if c >= "\x80" or c.isalnum() else " " for c in found).split(" ")
    cut = [w for w in cut if w]
    return cut, [*cut, *(f"{a} {b}" for a, b in zip(cut, cut[1:], strict=False))]


TEXTS = ["The cat, the CAT sat; it's 42!", "", None, "É é\xa0x", "日本語 テキスト", "word " * 3000, "x" * 5000, "a" * 300 + " " + "b" * 300, "one", "#$%"]


@pytest.mark.parametrize("block", [1 << 17, 50])
def test_buckets_of_texts_whole_or_in_blocks(monkeypatch, block):
    monkeypatch.setattr(resample, "BLOCK", block)
    got = {i: [] for i in range(len(TEXTS))}
    for owner, bucket in resample.feature_buckets([resample.words(t) for t in TEXTS], 2, 997):
        for o, b in zip(owner.tolist(), bucket.tolist(), strict=True):
            got[o].append(b)
    for i, t in enumerate(TEXTS):
        assert sorted(got[i]) == sorted(zlib.crc32(f.encode()) % 997 for f in plain_features(t)[1])


def brute(docs, target, percent, min_words, seed, buckets):
    own = [plain_features(t) for _, t in docs]
    hashed = [[zlib.crc32(f.encode()) % buckets for f in fs] for _, fs in own]
    s, t = [0] * buckets, [0] * buckets
    for h in hashed:
        for b in h:
            s[b] += 1
    for x in target:
        for f in plain_features(x)[1]:
            t[zlib.crc32(f.encode()) % buckets] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows = []
    for (d, _), (cut, _), h in zip(docs, own, hashed, strict=True):
        weight = math.floor(sum(gain[b] for b in h) / len(h)) if h else 0
        u = (int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16) + 0.5) / 4294967296
        rows.append((d, len(cut), len(h), weight, weight + math.floor(-1000 * math.log(-math.log(u)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    ranks = {}
    for i, r in enumerate(able[: percent * len(able) // 100]):
        ranks.setdefault(r, []).append(i + 1)
    return sorted(((*r, ranks[r].pop() if ranks.get(r) else None) for r in rows), key=str)


def test_draw_of_documents_against_plain_python(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    docs += [(None, docs[0][1]), (None, docs[0][1]), (-3, docs[1][1]), docs[5], docs[5], *((1000 + i, t) for i, t in enumerate(TEXTS)), *[(7, docs[2][1])] * 50]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()] + [None, ""]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS rank", "'x' AS weight")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.importance_resample(df, wanted, percent=40, min_words=3, seed=7, size=2, buckets=500)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, 40, 3, 7, 500)


def test_empty_tables_and_shares(spark):
    df = spark.createDataFrame([(i, "some words of a text " * 5) for i in range(8)], "doc_id bigint, text string")
    none = df.limit(0)
    assert resample.importance_resample(none, df).count() == 0
    whole = resample.importance_resample(df, none, percent=100).collect()
    assert sorted(r["rank"] for r in whole) == list(range(1, 9))
    assert [r["rank"] for r in sorted(whole, key=lambda r: (-r["score"], r["doc_id"]))] == list(range(1, 9))
    assert all(r["rank"] is None for r in resample.importance_resample(df, df, percent=0).collect())
    named = df.selectExpr("CAST(doc_id AS string) AS name", "text AS body", "doc_id AS n")
    assert sum(r["rank"] is not None for r in resample.importance_resample(named, df, percent=50, id_column="name", text="body", keep=("n",)).collect()) == 4
