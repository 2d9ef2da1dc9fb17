import json
import random

from pyspark.sql import functions as F

from jouleloom.operators.prices import (
    EPOCH,
    PRICE,
    add_cost,
    job_cost,
    nearest_prices,
    neighbours,
    price_block_cover,
)
from jouleloom.sources.prices import read_price_index, read_prices
from tests.helpers import rows_of, table


def test_nearest_price_ends_ties_and_nulls(spark):
    prices = spark.createDataFrame([(0, 1.0), (10, 2.0)], f"{EPOCH} bigint, {PRICE} double")
    df = spark.createDataFrame([(-3,), (4,), (5,), (6,), (99,), (None,)], "x bigint")
    rows = table(nearest_prices(df, prices, "x"), "x", PRICE, order=["x"])
    assert rows == [(None, None), (-3, 1.0), (4, 1.0), (5, 2.0), (6, 2.0), (99, 2.0)]
    none = nearest_prices(df, prices.limit(0), "x")
    assert none.where(F.col(PRICE).isNotNull()).count() == 0 and none.count() == 6


def test_nearest_price_equals_search(spark):
    rng = random.Random(4)
    times = sorted({rng.randrange(-9_000_000, 9_000_000) for _ in range(60)})
    prices = spark.createDataFrame([(t, float(i)) for i, t in enumerate(times)], f"{EPOCH} bigint, {PRICE} double")
    xs = [rng.randrange(-12_000_000, 12_000_000) for _ in range(500)]
    xs += [(a + b) // 2 for a, b in zip(times, times[1:])]
    df = spark.createDataFrame([(x,) for x in xs], "x bigint")
    found = table(nearest_prices(df, prices, "x", bucket_s=100_000), "x", "PriceEpochTime")
    assert len(found) == len(xs)
    for x, t in found:
        assert t == max(times, key=lambda e: (-abs(e - x), e))


def test_unsplit_neighbours(spark):
    prices = spark.createDataFrame([("a", t) for t in (0, 5, 9_000_000)] + [("b", 7)], f"s string, {EPOCH} bigint")
    rows = table(neighbours(prices, ["s"]), "s", EPOCH, "before", "after", order=["s", EPOCH])
    assert rows == [("a", 0, None, 5), ("a", 5, 0, 9_000_000), ("a", 9_000_000, 5, None), ("b", 7, None, None)]


def test_cost(spark):
    df = spark.createDataFrame(
        [("f", "g", 7_200_000.0, 7_200_000.0, 100.0)],
        f"file_label string, group_name string, Energy_used_J double, Energy_Increment_J double, {PRICE} double",
    )
    assert rows_of(job_cost(add_cost(df))) == [(0.2, "f", "g", 200.0)]


def test_block_cover(spark):
    blocks = spark.createDataFrame([(b,) for b in (100, 200, 300, 400)], "block bigint")
    cases = {(250, 350): [200, 300], (250, 260): [200, 300], (50, 60): [100], (500, 600): [400], (200, 200): [100, 200]}
    bounds = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "k int, min_ts bigint, max_ts bigint")
    found = price_block_cover(bounds, blocks, ["k"]).groupBy("k").agg(F.sort_array(F.collect_set("block")).alias("b"))
    assert [r["b"] for r in found.orderBy("k").collect()] == list(cases.values())
    assert price_block_cover(bounds, blocks.limit(0), ["k"]).count() == 0


def test_block_cover_equals_search(spark):
    rng = random.Random(9)
    blocks = sorted(rng.randrange(0, 40_000_000) for _ in range(40))
    bounds = [(i, *sorted(rng.randrange(-5_000_000, 45_000_000) for _ in range(2))) for i in range(50)]
    b = spark.createDataFrame([(x,) for x in blocks], "block bigint")
    df = spark.createDataFrame(bounds, "k int, min_ts bigint, max_ts bigint")
    expected = set()
    for k, low, high in bounds:
        later, earlier = [x for x in blocks if x >= low], [x for x in blocks if x < low]
        keep = set(later[:1] + earlier[-1:] + [x for x in blocks if low <= x <= high])
        expected |= {(k, x) for x in keep}
    assert set(table(price_block_cover(df, b, ["k"]), "k", "block")) == expected


def test_json_documents(spark, tmp_path):
    (tmp_path / "index.json").write_text(json.dumps({"timestamps": [3000, -1500]}))
    blocks = tmp_path / "blocks"
    blocks.mkdir()
    (blocks / "a.json").write_text('{"series":[[0,1.0],[10000,2.0],[20000,null],[],[10000,1.5]]}')
    (blocks / "b.json").write_text("not json at all")
    assert table(read_price_index(spark, str(tmp_path / "index.json")), "block", order=["block"]) == [(-2,), (3,)]
    assert table(read_prices(spark, str(blocks)), EPOCH, PRICE, order=[EPOCH]) == [(0, 1.0), (10, 1.5)]


def test_every_row_with_a_time_has_a_price(spark):
    """So interpolating prices over the rows could only change rows without a time: none precede them."""
    prices = spark.createDataFrame([(50, 1.0), (900, 4.0)], f"{EPOCH} bigint, {PRICE} double")
    df = spark.range(-100, 1500, 7).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("x"))
    found = nearest_prices(df, prices, "x")
    assert found.where(F.col("x").isNull() != F.col(PRICE).isNull()).count() == 0


def test_block_cover_moves_no_pair(spark):
    """Every pair is found once, so pairs are not shuffled to be made distinct; only bounds with the same key need that."""
    week = 7 * 86_400
    blocks = spark.range(200).select((F.col("id") * week).alias("block"))
    bounds = spark.range(30).select("id", (F.col("id") * week).alias("min_ts"), (F.col("id") * 5 * week + 3).alias("max_ts"))
    found = price_block_cover(bounds, blocks, ["id"])
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == found.distinct().count() > 30 * 10
    backwards = bounds.select("id", F.col("max_ts").alias("min_ts"), F.col("min_ts").alias("max_ts"))
    assert price_block_cover(backwards, blocks, ["id"]).groupBy("id", "block").count().where("count > 1").isEmpty()
    twice = bounds.unionByName(bounds.withColumn("max_ts", F.col("max_ts") + 20 * week))
    again = price_block_cover(twice, blocks, ["id"])
    assert again.count() == again.distinct().count() == price_block_cover(twice.where(F.col("max_ts") >= F.col("min_ts") + 20 * week), blocks, ["id"]).union(found).distinct().count()
