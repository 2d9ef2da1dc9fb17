import random

import pytest
from pyspark.sql import functions as F

from jouleloom.llm import linededup
from tests.llm import brute


def deduplicated(spark, docs, min_chars):
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id bigint, text string, n_lines string")
    return {r["doc_id"]: r for r in linededup.dedup_lines(df, min_chars).collect()}


@pytest.mark.parametrize("seed,letters,min_chars", [(1, "ab", 3), (2, "abcdefgh", 2), (3, "a", 4), (4, "abcd", 1)])
def test_equals_brute_force(spark, seed, letters, min_chars):
    rng = random.Random(seed)
    docs = [(i, "\n".join(rng.choice(letters) * rng.randint(0, 2) for _ in range(rng.randint(0, 14)))) for i in range(40)]
    docs += [(100 + i, docs[7][1]) for i in range(6)] + [(200, "q\n" + docs[3][1] + "\n" + docs[9][1])]
    got = deduplicated(spark, docs, min_chars)
    want = brute.dedup_lines(docs, min_chars)
    for (i, before), after in zip(docs, want, strict=True):
        assert got[i]["text"] == after, i
        assert got[i]["n_lines"] == before.count("\n") + 1
        assert got[i]["n_deleted"] == sum(r["stop"] - r["start"] for r in got[i]["deleted"] or [])


def test_nulls_long_texts_and_repeats(spark):
    long = "\n".join(f"line number {i % 700} of a very long text" for i in range(20_000))
    rows = [(None, "same line here"), (1, "same line here"), (1, "same line here"), (2, None), (3, ""), (4, long), (5, "same line here"), (6, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("deleted", F.lit(1))
    got = linededup.dedup_lines(df, 5).collect()
    assert len(got) == 8
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["text"])
    assert by[None] == ["same line here"] and by[1] == ["", ""] and by[5] == [""]
    assert by[2] == [None] and by[3] == by[6] == [""]
    assert by[4][0].split("\n") == long.split("\n")[:700]


def test_rows_given_twice_keep_their_lines(spark):
    df = spark.createDataFrame([(1, "only here\nand here")] * 2, "doc_id bigint, text string")
    assert [r["text"] for r in linededup.dedup_lines(df, 1).collect()] == ["only here\nand here"] * 2


def test_empty_table_and_nothing_repeated(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id bigint, text string")
    assert linededup.dedup_lines(df.limit(0)).count() == 0
    assert {r["text"] for r in linededup.dedup_lines(df, 1).collect()} == {"a", "b"}


def test_ranks_are_a_suffix_array(spark):
    rng = random.Random(3)
    docs = [[rng.choice("abc") for _ in range(12)] for _ in range(6)]
    rows = [(d, i, ord(x), 0) for d, doc in enumerate(docs) for i, x in enumerate(doc)]
    levels = linededup.suffix_levels(spark.createDataFrame(rows, "doc bigint, line bigint, h1 bigint, h2 bigint"))
    for k, level in enumerate(levels):
        found = [(r["rank"], docs[r["doc"]][r["line"] : r["line"] + 2**k]) for r in level.collect()]
        assert [b for _, b in sorted(found, key=lambda x: x[0])] == sorted(b for _, b in found)
        assert len({r for r, _ in found}) == len({tuple(b) for _, b in found})
