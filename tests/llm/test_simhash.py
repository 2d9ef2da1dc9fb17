import random

import pytest
from pyspark.sql import functions as F

from jouleloom.llm import simhash
from jouleloom.session import written
from jouleloom.llm.components import components
from jouleloom.llm.queries import REGISTRY
from tests.llm import brute


def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute.near_duplicates(docs)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in REGISTRY["op10_simhash_components"](spark, sf).collect()}
    assert got == want


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_links_of_planted_fingerprints(spark, bits):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    for p in list(prints):
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, bits + 1)):
                p ^= 1 << b
            prints.add(p)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fingerprint bigint"), bits).collect()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert {(r["a"], r["b"]) for r in found} == want and len(found) == len(want)


def test_components_of_random_and_long_graphs(spark):
    rng = random.Random(2)
    near = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)]
    near = [(a, b) for a, b in near if a != b] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    rng.shuffle(near)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(near, "a bigint, b bigint")).collect()}
    assert got == brute.components({x for e in near for x in e}, near)


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "Ä b c d", "a b c " * 20_000, "x y z\x0bw"])
def test_fingerprint(text):
    assert simhash.simhash(text, 3) & (2**64 - 1) == brute.simhash(text, 3)


def test_nulls_repeats_clashes_and_no_rows(spark):
    rows = [(5, None), (4, ""), (None, "a b c d"), (9, "a b c d"), (9, "a b c d"), (None, "lonely words stand here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fingerprint", F.lit("x"))
    got = sorted(((r["id"], r["component"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(5, 4), (4, 4), (None, 9), (9, 9), (9, 9), (None, None)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == sorted([(4, "", "x"), (None, "a b c d", "x"), (None, "lonely words stand here", "x")], key=str)
    again = simhash.one_of_each(df.where("doc_id = 9")).collect()
    assert len(again) == 1
    assert simhash.one_of_each(df.limit(0)).count() == 0


def flipped(x, bits):
    for b in bits:
        x ^= 1 << b
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("crowd", [512, 3])
def test_tally_filters_candidates_and_crowded_lists_lose_nothing(spark, monkeypatch, crowd):
    """Candidates share six bytes or more; of those only pairs at two bits stay, out of small and crowded lists."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(3)
    prints = {flipped(rng.getrandbits(64), []) for _ in range(300)}
    base = rng.getrandbits(64)
    prints |= {flipped(base, [rng.randrange(8), 8 + rng.randrange(8)]) for _ in range(60)} | {flipped(base, rng.sample(range(64), 2)) for _ in range(60)} | {flipped(base, [3, 4, 5, 6])}
    df = written(spark.createDataFrame([(p,) for p in prints], "fingerprint bigint"), "prints")
    ordered = sorted(prints)
    pairs = [(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :]]
    shared = {p: sum(x == y for x, y in zip(*(v.to_bytes(8, "big", signed=True) for v in p), strict=True)) for p in pairs}
    near = {(a, b) for a, b in pairs if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    got = {(r["a"], r["b"]): r for r in simhash.links(df, 2).collect()}
    assert set(got) == near and all(r["distance"] == ((a ^ b) & (2**64 - 1)).bit_count() for (a, b), r in got.items())
    candidates = {(r["a"], r["b"]): r["lists"] for r in simhash.tallied(df, 2).collect()}
    assert near <= set(candidates) <= {p for p in pairs if shared[p] >= 6}
    if crowd == 512:
        assert set(candidates) == {p for p in pairs if shared[p] >= 6} and len(candidates) > len(near)
        assert all(n == {6: 1, 7: 7}[shared[p]] for p, n in candidates.items()) and all(r["shared"] == shared[p] for p, r in got.items())
    else:
        assert len(candidates) < sum(s >= 6 for s in shared.values())


def test_postings_and_lists_are_not_sent_to_all_workers(spark, monkeypatch):
    """Of 20 000 fingerprints Spark expects less than a MB of postings, which are 560 000 rows."""
    plans = {}

    def seen(df, name, *rest):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return written(df, name, *rest)

    monkeypatch.setattr(simhash, "written", seen)
    rng = random.Random(9)
    prints = {rng.getrandbits(64) - 2**63 for _ in range(20_000)}
    prints |= {p ^ 1 for p in list(prints)[:500]}
    distinct = written(spark.createDataFrame([(p,) for p in prints], "fingerprint bigint"), "test-fingerprints")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        pairs = simhash.links(distinct, 2)
        assert "Broadcast" not in plans["simhash-lists"] and "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
        assert pairs.where("b = a ^ 1 AND distance = 1 AND shared = 7").count() == 500 == pairs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
