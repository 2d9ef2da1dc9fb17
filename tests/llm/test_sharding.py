import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jouleloom.llm import sharding
from jouleloom.llm.queries import REGISTRY
from tests.llm import brute


@settings(max_examples=3, deadline=None)
@given(keys=st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=30), shards=st.integers(1, 300))
def test_jump_hash_is_the_published_one(spark, keys, shards):
    df = spark.createDataFrame([(str(k),) for k in keys], "k string").withColumn("s", sharding.jump_hash(F.col("k").cast("decimal(20,0)"), shards))
    assert [r["s"] for r in df.collect()] == [brute.jump(k, shards) for k in keys]


def test_query(spark, sf):
    rows = REGISTRY["op1_jump_sharding"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
    for shard, n in Counter(r["shard"] for r in rows).items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))


def test_nulls_ties_repeats_clashes_and_no_rows(spark):
    rows = [(None, "a", 9), (1, "a", 9), (1, "a", 9), (2, None, 9), (None, None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, shard int")
    got = sharding.shard_slots(df, ["doc_id"], ["doc_id", "text"], 3).collect()
    assert len(got) == 5
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in by.values())
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert sharding.shard_slots(df.limit(0), ["doc_id"], ["doc_id"], 3).count() == 0


def test_written_shards(spark, tmp_path):
    df = spark.range(200).withColumnRenamed("id", "doc_id")
    sharding.write_shards(df, ["doc_id"], 4, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    expected = {r["doc_id"]: r["shard"] for r in sharding.assign_shards(df, ["doc_id"], 4).collect()}
    assert {r["doc_id"]: r["shard"] for r in back.collect()} == expected


def test_many_equal_rows_are_numbered_over_tasks(spark):
    """Copies of a row are counted, so that no task sorts them; they get numbers of their own all the same."""
    df = spark.range(300_000).selectExpr("IF(id % 3 = 0, id, NULL) AS doc_id", "IF(id % 3 = 0, 'x', '') AS text")
    got = sharding.shard_slots(df, ["doc_id"], ["doc_id", "text"], 3)
    per = got.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("slot").alias("d"), F.min("slot").alias("lo"), F.max("slot").alias("hi")).collect()
    assert sum(r["n"] for r in per) == 300_000 and all((r["d"], r["lo"], r["hi"]) == (r["n"], 0, r["n"] - 1) for r in per)
    sizes = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 150_000
