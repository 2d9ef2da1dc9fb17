import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from jouleloom.llm import decontam
from jouleloom.llm.queries import REGISTRY
from tests.llm import brute


def test_alignment_equals_brute_force():
    rng = random.Random(1)
    pairs = [([rng.randint(-1, 5) for _ in range(rng.randint(1, 40))], [rng.randint(0, 5) for _ in range(rng.randint(1, 15))]) for _ in range(80)]
    got = decontam.align([(np.array(a, np.int32), np.array(b, np.int32)) for a, b in pairs])
    for (a, b), (score, start, stop) in zip(pairs, got, strict=True):
        assert score == brute.smith_waterman(a, b)
        assert brute.smith_waterman(a[start:stop], b) == score


@pytest.mark.parametrize("reach", [3, 9])
def test_passages_hold_all_hits(monkeypatch, reach):
    monkeypatch.setattr(decontam, "LONG", 20)
    rng = random.Random(reach)
    items = decontam.Items(["a b c d e f", "c d e f g"])
    text = " ".join(rng.choice("abcdefgx") for _ in range(3000)) + " a b c d e f" * 30
    cut = decontam.words(text)
    want = {i for i in range(len(cut) - 3) if " ".join(cut[i : i + 4]) in "a b c d e f" or " ".join(cut[i : i + 4]) in "c d e f g"}
    covered = set()
    for start, numbers, grams in decontam.passages(text, items.numbers, items.keys, reach):
        assert len(numbers) <= 24 + 2 * reach and len(grams)
        covered |= {i for i in want if start <= max(i - reach, 0) and min(i + 4 + reach, len(cut)) <= start + len(numbers)}
    assert covered == want


def test_query_equals_brute_force(spark, sf):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in REGISTRY["op3_benchmark_leaks"](spark, sf).collect()}
    short = {d for d, _ in got if len(docs[d]) < 2500} | set([d for d in docs if len(docs[d]) < 1200][:25])
    want = brute.leaks([(d, docs[d]) for d in short], items)
    assert want and {k: v for k, v in got.items() if k[0] in short} == pytest.approx(want)


def test_edited_copies_and_frequent_passages(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(make(40))) for i in range(5)]
    docs = []
    for d in range(60):
        text, copied = make(80), items[d % 5][1].split()
        if d % 3 == 0:  # exchange, leave out and put in words
            copied = [x for k, w in enumerate(copied) for x in ([] if k % 17 == 16 else ["other"] if k % 13 == 7 else [w, "new"] if k % 19 == 11 else [w])]
        docs.append((d, " ".join(text[:40] + copied + text[40:]).upper() if d % 2 else ", ".join(text[:40] + copied + text[40:])))
    docs += [(100 + d, " ".join(make(120))) for d in range(20)]
    got = {(r["id"], r["item"]): r["score"] for r in decontam.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = brute.leaks(docs, items)
    assert got == pytest.approx(want) and {k for k in got} == {(d, d % 5) for d in range(60)}


@pytest.mark.parametrize("every", [5, 6])
def test_edited_copies_beside_exact_ones(spark, every):
    rng = random.Random(every)
    items = [(i, " ".join(f"w{rng.randint(0, 900)}" for _ in range(30))) for i in range(4)]
    edit = lambda text, first: " ".join(f"x{k}" if k % every == first else w for k, w in enumerate(text.split()))
    docs = [(i, "so it is " + edit(t, 2) + " and on") for i, t in items] + [(100 + i, "copy " + t) for i, t in items]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["id"], r["item"]): r["score"] for r in decontam.leaks(*frames).collect()}
    assert len(got) == 8 and got == pytest.approx(brute.leaks(docs, items))


def test_scripts_without_spaces_and_short_items(spark):
    rng = random.Random(12)
    signs = "日月火水木金土山川田人口車門雨電気学校先生時間東西南北春夏秋冬犬猫鳥魚花草"
    chinese = lambda n: "".join(rng.choice(signs) for _ in range(n))
    items = [(0, chinese(30)), (1, "ก" + "".join(rng.choice("กขคงจฉชซ") for _ in range(24))), (2, "three word item"), (3, "two tokens"), (4, "single"), (5, chinese(3)), (6, "mixed 東京 text of 大阪")]
    edited = "".join("空" if k % 9 == 4 else c for k, c in enumerate(items[0][1]))
    docs = [
        (0, chinese(200) + "。" + items[0][1] + chinese(50)), (1, chinese(90) + edited), (2, "x " + items[1][1] + " y"), (3, "a Three, word ITEM here"), (4, "three word and item"), (5, "of two tokens"),
        (6, "two other tokens"), (7, "single"), (8, "犬" + items[5][1] + "猫"), (9, "so mixed 東京 text of 大阪 it is"), (10, chinese(400)), (11, "plain words only, nothing of it"),
    ]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["id"], r["item"]): r["score"] for r in decontam.leaks(*frames).collect()}
    assert {(0, 0), (1, 0), (2, 1), (3, 2), (5, 3), (8, 5), (9, 6)} <= set(got) and not {d for d, _ in got} & {4, 6, 7, 11}
    assert got == pytest.approx(brute.leaks(docs, items))
    assert {r["doc_id"] for r in decontam.decontaminate(*frames).collect()} == {d for d, _ in docs} - {d for d, _ in got}


def test_a_pair_is_made_once_on_its_rarest_ngram():
    """A phrase of all items makes no pair that has not the words for it, and the rarest n-gram leads."""
    phrase = "which of the following is"
    items = decontam.Items([f"{phrase} " + " ".join(f"w{i}x{k}" for k in range(20)) for i in range(200)])
    text = "so " + phrase + " " + " ".join(f"w7x{k}" for k in range(6, 18))
    ((_, passage, grams),) = decontam.passages(text, items.numbers, items.keys, 100)
    assert len(grams) > 8 and items.pairs(passage, grams, 0.4).tolist() == [7]
    common = decontam.passages("now " + phrase + " true", items.numbers, items.keys, 100)
    ((_, passage, grams),) = common
    assert items.pairs(passage, grams, 0.4).tolist() == [] and len(items.pairs(passage, grams, 0.1)) == 200
    two = decontam.Items([f"{phrase} {x}" for x in ("one more", "another one")])
    ((_, passage, grams),) = decontam.passages(phrase + " another one", two.numbers, two.keys, 9)
    assert two.pairs(passage, grams, 0.3).tolist() == [1, 0]


def test_nothing_of_the_documents_is_shuffled(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    left = decontam.decontaminate(docs, spark.createDataFrame([(1, "a b c d e")], "item_id bigint, text string"))
    assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString() and left.count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 9)) for _ in range(20))) for i in range(9)]
    docs = [(d, "so " + items[d % 9][1] + " on") for d in range(20)]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    whole = sorted(map(tuple, decontam.leaks(*frames).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    assert sorted(map(tuple, decontam.leaks(*frames).collect())) == whole and len(whole) == 20


def test_nulls_long_texts_repeats_clashes_and_no_rows(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, "x " + item), (1, item), (1, item), (2, None), (3, ""), (4, "pad " * 50_000 + item), (5, "one two three")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item", F.lit(1)).withColumn("one", F.lit(2))
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (None, "q r s t u"), (9, ""), (10, "two words")], "item_id bigint, text string")
    got = sorted(((r["id"], r["item"], r["score"], r["start"], r["stop"]) for r in decontam.leaks(docs, items).collect()), key=str)
    assert got == sorted([(None, 7, 1.0, 1, 11), (1, 7, 1.0, 0, 10), (4, 7, 1.0, 50_000, 50_010)], key=str)
    left = decontam.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 5]
    assert decontam.leaks(docs.limit(0), items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).count() == 7
