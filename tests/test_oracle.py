"""Every registered query with an oracle equals its DuckDB SQL (as a multiset of rows)."""

import os

import pytest

from conftest import ROOT, SF_ORACLE
from oracle_compare import run
from urbanlake.plans.catalog import QUERIES
from urbanlake.plans.oracle import ORACLE

import __spark_entry__ as entry_mod


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = run(spark, name, SF_ORACLE, QUERIES, ORACLE)
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["rows_match"], (r["spark_rows"], r["oracle_rows"])
    assert r["values_match"], r["examples"]


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(entry_mod.oracle_sql()) >= set(ORACLE) and set(entry_mod.queries()) >= set(QUERIES)
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    if not os.path.isdir(os.path.join(ROOT, "urbanlake", "llm")):       # the corpus operators are taken out
        assert set(entry_mod.oracle_sql()) == set(ORACLE) and set(entry_mod.queries()) == set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "event_date" in df.columns
