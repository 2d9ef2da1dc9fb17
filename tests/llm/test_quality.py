import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jouleloom.llm import quality
from jouleloom.llm.queries import REGISTRY
from tests.llm import brute


@pytest.mark.parametrize("seed", range(4))
def test_statistics(seed):
    rng = random.Random(seed)
    for _ in range(60):
        text = "".join(rng.choice(["a", "b", "é", " ", " ", "\n", "\t", "#", "<", "\x0b", "日", "a b a b a b "]) for _ in range(rng.randint(0, 90)))
        assert quality.statistics(text) == brute.statistics(text), text


def test_sorted_hash_array():
    rng = np.random.default_rng(1)
    slots = np.unique(rng.integers(0, 1 << quality.SLOT_BITS, 5000))
    array = quality.HashArray(*quality.sorted_hash_array(slots, np.arange(len(slots))))
    asked = np.concatenate([slots, rng.integers(0, 1 << quality.SLOT_BITS, 5000)])
    at = array.find(asked)
    assert (array.values[at[: len(slots)]] == np.arange(len(slots))).all() and len(array.begin) > 5000
    assert ((at >= 0) == np.isin(asked, slots)).all()


def test_probabilities_equal_the_definition(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcde ") for _ in range(200)) for _ in range(12)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    model, want = quality.Model(quality.train(df)), brute.KneserNey(texts)
    for text in (*texts[:3], "abc abc abz", "zzz"):
        packed, _ = quality.grams([text.encode()])
        got = -float(model.log_probability(packed, quality.language_seed("en")).sum()) / len(text.split())
        assert got == pytest.approx(want.per_word(text), rel=0.01)


def test_unseen_ngrams_miss_in_a_full_array():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 40, 4_000_000))
    slots = np.sort(quality.slot(keys, 7, 5, False))
    array = quality.HashArray(*quality.sorted_hash_array(slots, np.zeros(len(slots))))
    other = np.setdiff1d(rng.integers(0, 1 << 40, 200_000), keys)
    assert (array.find(quality.slot(other, 7, 5, False)) < 0).all()
    at = array.find(quality.slot(keys, 7, 5, False))
    assert len(np.unique(at)) == len(keys) and at.min() == 0


def test_unseen_ngrams_equal_the_definition(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz .,") for _ in range(4000)) for _ in range(60)]
    df = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string")
    tables, want = quality.estimate(quality.gram_counts(df, "text", "lang")), brute.KneserNey(texts)
    model = quality.Model(quality.train(df))
    other = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz .,#") for _ in range(3000))
    packed, _ = quality.grams([other.encode()])
    logs = [math.log(want.p(int(g).to_bytes(5, "big"))) for g in packed]
    assert model.log_probability(packed, quality.language_seed("en")) == pytest.approx(logs, rel=1e-4)
    asked = spark.createDataFrame([("en", g) for g in sorted(set(packed.tolist()))], "lang string, gram bigint")
    found = {r["gram"]: r["log_p"] for r in quality.looked_up(asked, tables).collect()}
    assert [found[g] for g in packed.tolist()] == pytest.approx(logs, rel=1e-9)


def test_a_model_that_is_not_sent_gives_the_same(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.union(spark.createDataFrame([(-1, None, "xx"), (-2, "", "xx"), (-3, "x y z", None)], docs.schema))
    want = {r["doc_id"]: r["quality"] for r in quality.quality(docs).collect()}
    monkeypatch.setattr(quality, "BROADCAST", 0)
    monkeypatch.setattr(quality, "PART_BYTES", 1 << 16)
    got = {r["doc_id"]: r["quality"] for r in quality.quality(docs).collect()}
    assert set(got) == set(want)
    for d, q in got.items():
        assert [q[c] for c in ("n_words", "n_symbols", "base_failed", "kept")] == [want[d][c] for c in ("n_words", "n_symbols", "base_failed", "kept")]
        if q["n_words"]:
            assert q["log_perplexity"] == pytest.approx(want[d]["log_perplexity"], rel=1e-5)


def test_probabilities_sum_to_one(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog"] * 3
    tables = quality.estimate(quality.gram_counts(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string"), "text", "lang"))
    want = brute.KneserNey(texts)
    p = {r["gram"].to_bytes(5, "big"): r["p"] for r in tables[-1][0].collect()}
    for gram, value in p.items():
        assert value == pytest.approx(want.p(gram), rel=1e-9)
    for h in {g[:-1] for g in p}:
        assert sum(want.p(h + bytes([b])) for b in range(256)) == pytest.approx(1)


def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute.quality(docs)
    rows = {r["doc_id"]: r for r in REGISTRY["op2_perplexity_rules"](spark, sf).collect()}
    assert set(rows) == set(want)
    for d, text, _ in docs:
        r = rows[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.statistics(text)
        failed, kept, value = want[d]
        assert r["base_failed"] == failed
        if value is not None:
            assert r["log_perplexity"] == pytest.approx(value, rel=1e-4)
        if not failed and min(abs(r["log_perplexity"] - r["low"]), abs(r["log_perplexity"] - r["high"])) > 1e-3:
            assert r["kept"] == kept


def test_medians_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "RANKED", 50)
    rng = random.Random(5)
    rows = [(k, rng.choice([rng.random(), 0.25])) for k in ("a", "b", None) for _ in range({"a": 2001, "b": 400, None: 1}[k])]
    df = spark.createDataFrame([(k or "", v) for k, v in rows], "lang string, x double")
    got = {r["lang"]: r["v"] for r in quality.medians(df, F.col("x")).collect()}
    assert got == {k or "": sorted(v for n, v in rows if n == k)[(sum(n == k for n, _ in rows) - 1) // 2] for k in ("a", "b", None)}


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    text = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text").contains("### ").alias("symbols"))
    rows = REGISTRY["op2_perplexity_rules"](spark, sf).join(labels, "doc_id").join(text, "doc_id").where("not base_failed").collect()
    clean = [r["kept"] for r in rows if r["quality"] == 1]
    junk = [r["kept"] for r in rows if r["quality"] == 0 and r["symbols"]]
    assert sum(clean) / len(clean) > 0.98 and junk and not any(junk)


def test_nulls_long_texts_repeats_clashes_and_no_rows(spark):
    good = " ".join(f"word{i % 37} and{i % 11}" for i in range(40))
    rows = [(1, None, "en"), (2, "", "en"), (3, good, None), (3, good, None), (4, "a b " * 200_000, "en"), (None, good + " end", None), (5, " \n ", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("quality", F.lit("clash")).withColumn("n", F.lit(1))
    got = quality.quality(df).collect()
    assert len(got) == 7
    for r in got:
        q = r["quality"]
        assert q["base_failed"] == (r["doc_id"] in (1, 2, 4, 5)) and (q["kept"] != q["base_failed"])
        assert (q["log_perplexity"] is None or math.isnan(q["log_perplexity"])) == (q["n_words"] == 0)
    assert quality.quality(df.limit(0)).count() == 0


@pytest.mark.parametrize("entries", [quality.BROADCAST, 0])
def test_texts_without_words_among_others_of_their_language(spark, monkeypatch, entries):
    monkeypatch.setattr(quality, "BROADCAST", entries)
    rng = random.Random(8)
    rows = [(d, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randint(0, 99)) for _ in range(30)), "en") for d in range(20)]
    df = spark.createDataFrame([*rows, (20, None, "en"), (21, "", "en"), (22, " \n\t", "en")], "doc_id bigint, text string, lang string")
    got = {r["doc_id"]: r["quality"] for r in quality.quality(df).collect()}
    assert set(got) == set(range(23)) and any(got[d]["kept"] for d in range(20))
    for d, q in got.items():
        assert (q["n_words"], q["base_failed"]) == ((0, True) if d >= 20 else (30, False))
        assert (q["low"] is None) == (q["high"] is None) == (d >= 20) and not (d >= 20 and q["kept"])
