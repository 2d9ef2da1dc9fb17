import numpy as np
import pytest
from pyspark.sql import functions as F

from jouleloom.llm import langid
from jouleloom.llm.queries import REGISTRY


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = REGISTRY["op8_byte_cnn"](spark, sf).join(lang, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def small_network(seed, languages=3, filters=4):
    rng = np.random.default_rng(seed)
    made = [rng.normal(0, 0.3, (w, 256, filters)) for w in langid.WIDTHS]
    size = filters * len(langid.WIDTHS)
    return langid.Network(list("xyz")[:languages], made, rng.normal(0, 0.1, size), rng.normal(0, 0.3, (size, languages)), rng.normal(0, 0.1, languages))


def plain_probabilities(net, row):
    """One window by explicit loops over filters, places and bytes."""
    pooled = []
    for weights in net.filters:
        for f in range(weights.shape[2]):
            pooled.append(max(sum(weights[k, row[p + k], f] for k in range(len(weights))) for p in range(langid.WINDOW)))
    hidden = [max(v + b, 0.0) for v, b in zip(pooled, net.bias, strict=True)]
    scores = [sum(h * net.dense[i, c] for i, h in enumerate(hidden)) + net.dense_bias[c] for c in range(len(net.languages))]
    powers = [np.exp(s - max(scores)) for s in scores]
    return [p / sum(powers) for p in powers]


def test_forward_pass_equals_explicit_loops():
    rng = np.random.default_rng(4)
    net, rows = small_network(1), rng.integers(0, 256, (5, langid.WINDOW + max(langid.WIDTHS) - 1)).astype(np.uint8)
    assert net.probabilities(rows) == pytest.approx(np.array([plain_probabilities(net, r) for r in rows]), rel=1e-9)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = small_network(2)
    rows = rng.integers(97, 105, (6, langid.WINDOW + max(langid.WIDTHS) - 1)).astype(np.uint8)
    labels = rng.integers(0, 3, 6)
    loss = lambda: -np.log(net.probabilities(rows)[np.arange(6), labels]).mean()
    weights = [*net.filters, net.bias, net.dense, net.dense_bias]
    for w, g in zip(weights, langid.gradients(net, rows, labels), strict=True):
        assert w.shape == g.shape
        flat, own = w.reshape(-1), g.reshape(-1)
        for i in {*rng.integers(0, len(flat), 8).tolist(), *np.argsort(-np.abs(own))[:8].tolist()}:
            kept, step = flat[i], 1e-6
            flat[i] = kept + step
            above = loss()
            flat[i] = kept - step
            below = loss()
            flat[i] = kept
            assert own[i] == pytest.approx((above - below) / (2 * step), rel=1e-4, abs=1e-8)


def test_training_fits_what_can_be_told_apart():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 101, (40, langid.WINDOW + 3)).astype(np.uint8)
    rows[20:, ::3] = 104
    labels = np.repeat([0, 1], 20)
    net = langid.fit(rows, labels, ["x", "y"])
    assert (net.probabilities(rows).argmax(axis=1) == labels).all()


def test_texts_together_equal_each_alone(net, monkeypatch):
    texts = ["the fox jumps", None, "der fuchs springt über " * 300, "12", "", "the quick brown " * 50, "der"]
    alone = [langid.identify(net, t) for t in texts]
    for together in (1, 3, 10_000):
        monkeypatch.setattr(langid, "TOGETHER", together)
        got = langid.identify_all(net, texts)
        assert [x for x, _ in got] == [x for x, _ in alone] and [x for _, x in got] == pytest.approx([x for _, x in alone], rel=1e-5)


def test_training_over_the_bound_takes_the_same_windows(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_WINDOWS", 1)
    rows = [(f"some words number {i} of {i * 7}", "en") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string")
    first = langid.labelled_windows(df.repartition(5), "text", "lang", 3)[0]
    again = langid.labelled_windows(df.repartition(2, "text"), "text", "lang", 3)[0]
    assert first.tobytes() == again.tobytes()


def test_null_ids_are_held_out(spark, tmp_path):
    docs = [(i, f"the quick brown fox {i}", "en") for i in range(20)] + [(None, "der schnelle fuchs", "de"), (21, None, None)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in REGISTRY["op8_byte_cnn"](spark, str(tmp_path)).collect()}
    assert rows[None]["held_out"] is True and rows[None]["lang_pred"] == "en" and all(r["held_out"] is not None for r in rows.values())


def test_windows_hold_every_byte():
    text = "Ab1cé  " * 300
    rows = langid.windows(text)
    joined = b"".join(r[: langid.WINDOW].tobytes() for r in rows).rstrip(b" ")
    assert joined == " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()).encode()


@pytest.fixture(scope="module")
def net(spark):
    rows = [(f"the quick brown fox number{i} jumps over", "en") for i in range(40)] + [(f"der schnelle braune fuchs{i} springt über", "de") for i in range(40)]
    return langid.train(spark.createDataFrame(rows, "text string, lang string"))


def test_nulls_long_texts_repeats_clashes_and_no_rows(spark, net):
    rows = [(1, None), (2, ""), (3, "12 34 !!"), (4, "der fuchs springt über " * 20_000), (None, "the fox jumps over the"), (4, "日本語"), (5, "the fox"), (5, "the fox")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("lang_pred", F.lit(1)).withColumn("score", F.lit(1))
    got = langid.identify_language(df, net).collect()
    assert sorted(str(r["lang_pred"]) for r in got if r["doc_id"] in (1, 2, 3)) == ["und"] * 3
    assert {r["lang_pred"] for r in got if r["doc_id"] == 4} <= {"de", "en"} and len(got) == 8
    assert langid.identify(net, "der fuchs springt über " * 20_000)[0] == "de" and langid.identify(net, "the fox jumps over the")[0] == "en"
    assert langid.identify_language(df.limit(0), net).count() == 0


def test_no_labels(spark):
    df = spark.createDataFrame([("hello there", None), (None, "en")], "text string, lang string")
    net = langid.train(df)
    assert net.languages == [] and langid.identify(net, "hello") == ("und", 0.0)
