"""The registered queries against their SQL, and what they return for the rest."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from tidemark.llm.duckdb_sql import ORACLES
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], SF) is None


def test_decoding_gives_the_texts_back(spark, con):
    got = QUERIES["op3_sentencepiece"](spark, SF).select("doc_id", "decoded_sha256").collect()
    want = con.execute("SELECT doc_id, sha256(text) FROM documents").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)


def test_chat_runs_without_python(spark):
    plan = QUERIES["op9_chat_format"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"pipeline", "op3_sentencepiece", "op10_packing", "op13_whitening"}))
def test_one_row_for_each_row(spark, con, name):
    table, key = ("pages", "page_id") if name == "op2_html" else ("documents", "doc_id")
    got = sorted(r[0] for r in QUERIES[name](spark, SF).select(key).collect())
    assert got == sorted(r[0] for r in con.execute(f"SELECT {key} FROM {table}").fetchall())
