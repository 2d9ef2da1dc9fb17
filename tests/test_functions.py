import random

from pyspark.sql import functions as F

from jouleloom.functions import (
    dataset_prefix,
    file_stem,
    fixed2,
    job_id,
    mask_secret,
    normalize_prefix,
    object_name_is_valid,
    round_half_even,
    sanitize_object_name,
    storage_key,
    table_name,
    unit_name,
    with_appliance,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def each(spark, values, schema, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    return [r[1] for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_rounding_is_that_of_exact_binary_values(spark):
    rng = random.Random(0)
    xs = [0.125, 2.675, 1.005, -2.5, 0.25, 0.35, 99.995, -0.004, 1e17, 128860376967288.59375]
    xs += [rng.choice([1, -1]) * round(rng.random() * 10 ** rng.randint(0, 6), rng.randint(1, 4)) for _ in range(2000)]
    xs = [x for x in xs if x != 0]
    assert each(spark, xs, "double", lambda v: round_half_even(v, 1)) == [round(x, 1) for x in xs]
    assert each(spark, xs, "double", lambda v: round_half_even(v, 2)) == [round(x, 2) for x in xs]
    assert each(spark, xs, "double", fixed2) == [f"{x:.2f}" for x in xs]
    special = [float("nan"), float("inf"), float("-inf"), None]
    assert each(spark, special, "double", fixed2) == ["nan", "inf", "-inf", None]


def test_appliance(spark):
    cases = {
        None: ("negligible usage", 0.0, "s"),
        0.0: ("negligible usage", 0.0, "s"),
        -5.0: ("negligible usage", 0.0, "s"),
        float("nan"): ("negligible usage", 0.0, "s"),
        30.0: ("a light bulb", 0.5, "s"),
        50.0: ("a light bulb", 0.8, "s"),
        700.0: ("a light bulb", 11.7, "s"),
        9000.0: ("a light bulb", 2.5, "m"),
        36000.0: ("a light bulb", 10.0, "m"),
        90000.0: ("a refrigerator", 10.0, "m"),
        1080000.0: ("a hair dryer", 10.0, "m"),
        5000000.0: ("a hair dryer", 46.3, "m"),
        12000000.0: ("a hair dryer", 1.85, "h"),
        1e9: ("a hair dryer", 154.32, "h"),
    }
    df = spark.createDataFrame(list(enumerate([*cases, 1e15])), "i int, j double")
    rows = with_appliance(df, "j").orderBy("i").collect()
    assert [tuple(r)[2:5] for r in rows[:-1]] == list(cases.values())
    sentence = {r["j"]: r["appliance_description"] for r in rows}
    assert sentence[36000.0] == "That's about the same energy as using a light bulb for 10.0 minutes."
    assert sentence[0.0] == "Energy use too small to compare with everyday appliances."
    assert sentence[1e15] == "That's about the same energy as using a hair dryer for 154320987.65 hours."
    assert each(spark, ["s", "m", "h", "d"], "string", unit_name) == ["seconds", "minutes", "hours", "d"]


def test_dataset_prefix(spark):
    parts = [["g", "Energy"], ["g", "Tasks", "0"], ["x"], ["g", "a/b"], ["g", ""], ["g", "", "T"]]
    expected = ["Energy", "Tasks__0", "x", "a_b", "g__", "T"]
    assert each(spark, parts, "array<string>", dataset_prefix) == expected


def test_names(spark):
    assert each(spark, ["123_abc_x", "123", "_x"], "string", job_id) == ["123", "123", ""]
    assert one(spark, table_name(F.lit("a/b"))) == "job_a_b"
    assert each(spark, ["/a", "a/", "", "a/b", "//a"], "string", normalize_prefix) == ["a/", "a/", "", "a/b/", "/a/"]
    paths = ["in/u/x.h5", "x.tar.h5", ".h5", "noext"]
    assert each(spark, paths, "string", file_stem) == ["x", "x.tar", ".h5", "noext"]


def test_object_names(spark):
    names = ["report.csv", "folder-1.data", "invalid name.txt", "semi;colon.txt", "../escape.txt", ""]
    safe = each(spark, names, "string", sanitize_object_name)
    assert safe[:4] == ["report.csv", "folder-1.data", "invalid_name.txt", "semi_colon.txt"]
    assert each(spark, safe, "string", object_name_is_valid) == [True] * 4 + [False] * 2
    assert one(spark, storage_key(F.lit("u"), F.lit("a.h5"))) == "u/a.h5"


def test_mask_secret(spark):
    values = [None, "", "abcd", "ab", "abcdef"]
    assert each(spark, values, "string", mask_secret) == ["<missing>", "<missing>", "****", "**", "abcd***"]
