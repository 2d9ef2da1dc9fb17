from itertools import permutations

import numpy as np
import pytest

from jouleloom.llm import filteraudit


def brute(docs, labels):
    """Every order applied to every document, one filter after the other."""
    fails = {}
    for i, (d, t, _) in enumerate(docs):
        t = t or ""
        words = [w for w in t.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
        fails[i] = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": any((u or "") == t and d is not None and e is not None and e < d for e, u, _ in docs),
        }
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, x in labels if x == 1}
    out = []
    for part in {p or "" for _, _, p in docs}:
        own = [i for i, (_, _, p) in enumerate(docs) if (p or "") == part]
        shapley, rows = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = set(own)
            for step, f in enumerate(order, 1):
                gone = {i for i in left if fails[i][f]}
                left -= gone
                shapley[f] += len(gone)
                rows.append((
                    part, "".join(order), step, len(left), len(gone), sum(fails[i][f] for i in own) - len(gone), sum(fails[i][f] and sum(fails[i].values()) == 1 for i in own),
                    sum(docs[i][0] in good for i in gone), sum(docs[i][0] in toxic for i in gone), f,
                ))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def test_removal_steps_are_the_first_failing_filter():
    orders = np.array(list(permutations(range(4))))
    steps = filteraudit.removal_steps(4, orders)
    for s in range(16):
        for c, order in enumerate(orders):
            at = next((k for k, f in enumerate(order) if s >> f & 1), None)
            assert steps[s, c] == (filteraudit.INFINITE if at is None else at)


@pytest.fixture(scope="module")
def given_rows():
    long = " ".join(f"w{i}" for i in range(250))
    docs = [
        (1, None, "en"), (2, "", None), (3, long, "en"), (9, long, "de"), (9, long, "de"), (4, long, None), (3, long, "en"), (None, long, "en"), (None, long, "en"),
        (5, "same " * 400, "en"), (6, "SAME " * 400, ""), (7, long + " #", "de"), (8, long + "\x0btail\x1c$", "de"), (10, "é" * 900 + " ABC" * 80, "en"), (11, "x" * 200_000, "fr"),
        (12, "Ünï " + long.upper(), "fr"), (13, " ".join(["a", "b"] * 100), "fr"), (14, " ".join(["a", "b", "c", "d"] * 50) + "\n", "fr"),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (9, 1, None), (5, None, 1), (None, 1, 1), (77, 1, 1), (12, 1, 0), (6, 0, 1)]
    return docs, labels


def test_audit_against_every_order_applied(spark, given_rows):
    docs, labels = given_rows
    df = spark.createDataFrame([(*d, 5) for d in docs], "doc_id bigint, text string, lang string, quality int")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = sorted(tuple(r) for r in filteraudit.filter_audit(df, known).collect())
    assert got == brute(docs, [x for x in labels if x[0] is not None])
    assert len(got) == 4 * 600


def test_no_rows_and_no_labels(spark, given_rows):
    docs, _ = given_rows
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    known = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filteraudit.filter_audit(df.limit(0), known).count() == 0
    assert sorted(tuple(r) for r in filteraudit.filter_audit(df, known).collect()) == brute(docs, [])


def test_shares_of_all_orders_add_up(spark, sf):
    df, known = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = filteraudit.filter_audit(df, known).collect()
    for part in {r["part"] for r in rows}:
        own = [r for r in rows if r["part"] == part]
        total = df.where(df.lang == part).count()
        left = {r["kept"] for r in own if r["step"] == 5}
        assert len(left) == 1 and {r["kept"] + r["removed"] for r in own if r["step"] == 1} == {total}
        shapley = {r["filter_order"][r["step"] - 1]: r["shapley"] for r in own}
        assert sum(shapley.values()) == 120 * (total - left.pop())
