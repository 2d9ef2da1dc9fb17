"""Corpus queries that SQL can express against their SQL; the contract's columns and types for all."""

import pytest

from jouleloom.llm.queries import ORACLES, REGISTRY
from tests.compare import check, connect

CONTRACT = {
    "op1_": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
    "op2_": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op4_": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op8_": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op9_": "page_id bigint, url string, text string, n_chars bigint",
    "op10_": "doc_id bigint, fingerprint string, component_id bigint",
    "op11_": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
    "op12_": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op13_": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    problem, rows = check(spark, sf, name, connect(sf))
    assert problem is None and rows > 0


@pytest.mark.parametrize("number", CONTRACT)
def test_columns_and_types(spark, sf, number):
    found = dict(next(q for n, q in REGISTRY.items() if n.startswith(number))(spark, sf).dtypes)
    for column, kind in (c.split() for c in CONTRACT[number].split(", ")):
        assert found[column] == kind, column


def test_one_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in REGISTRY) for k in range(1, 14)] == [1] * 13
