import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from jouleloom.llm.queries import vocabulary
from tests.llm import brute
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents of one language, junk, repeated runs, near-copies and benchmark passages."""
    rng = random.Random(11)
    sounds = ["an", "er", "th", "in", "on", "re", "ed", "ou", "sh", "ti"]
    word = lambda: "".join(rng.choice(sounds) for _ in range(rng.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    items = [(i, line(30)) for i in range(6)]
    shared = "\n".join(line(20) for _ in range(3))
    docs = []
    for d in range(70):
        lines = [line(rng.randint(8, 16)) for _ in range(rng.randint(4, 9))]
        if d % 10 == 3:
            lines.insert(2, shared)
        if d % 14 == 5:
            lines.insert(1, items[d % 6][1])
        docs.append((d, "\n".join(lines), "en", f"s{d % 3}", 1))
    docs += [(100 + d, docs[d][1], "en", "copy", 1) for d in range(4)]
    docs += [(200 + d, " ".join(docs[d][1].split("\n")), "en", "near", 1) for d in range(20, 24)]
    docs += [(300, " ".join(w + "###$$$" for w in line(80).split()), "en", "junk", 1), (301, "short one", "en", "junk", 1), (302, None, "en", None, None), (None, "\n".join(line(12) for _ in range(4)), "en", None, 1)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, items


def expected(docs, items):
    """The ids, texts and n_chars that each stage leaves, by plain Python."""
    judged = brute.quality([(i, d[1], d[2]) for i, d in enumerate(docs)])
    left = sorted(((d[0], d[1], d[4]) for i, d in enumerate(docs) if judged[i][1]), key=lambda d: (d[0] is not None, d[0] or 0))
    yield left
    texts = brute.dedup_lines([(d, t) for d, t, _ in left], 100)
    left = [(d, t, n if t == before else len(t)) for (d, before, n), t in zip(left, texts, strict=True) if t == before or brute.SPACE.search(t)]
    yield left
    reached = brute.near_duplicates([(i, t) for i, (_, t, _) in enumerate(left)])  # in order of ids
    left = [d for i, d in enumerate(left) if reached[i][1] == i]
    yield left
    leaking = {i for i, _ in brute.leaks([(i, t) for i, (_, t, _) in enumerate(left)], items)}
    left = [d for i, d in enumerate(left) if i not in leaking]
    yield left


def test_stages_equal_brute_force(spark, corpus):
    folder, docs, items = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = []
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected(docs, items), strict=False):
        out = corpus_pipeline.written(stage(spark, frame, folder), "test")
        assert out.columns == frame.columns, name
        got = sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()), key=lambda d: (d[0] is not None, d[0] or 0))
        assert got == want, name
        sizes.append(len(got))
        frame = out
    assert sizes == sorted(sizes, reverse=True) and len(set(sizes)) == 4
    library = Tokenizer.from_file(vocabulary())
    ids = {d: [*library.encode(t, add_special_tokens=False).ids, 0] for d, t, _ in want}
    check_packing(corpus_pipeline.run(spark, folder).collect(), ids, 1024)


def test_stages_on_no_rows_and_extra_columns(spark, corpus):
    folder, *_ = corpus
    frame = spark.read.parquet(f"{folder}/documents.parquet").limit(0).selectExpr("*", "1 AS quality", "2 AS n_lines", "3 AS deleted", "4 AS fingerprint", "5 AS one")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, folder)
        assert out.columns == frame.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, frame, folder).count() == 0
