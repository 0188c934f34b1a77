"""Every registered query against its DuckDB oracle on the driver tables.

Runs at sf0.01, the scale of the driver's correctness check, with a time limit
for each oracle statement; TERRASCORE_ORACLE_SF names another scale.
"""

import os
import time

import pytest

import __spark_entry__ as E
from harness import compare, duck_connect
from terrascore.plans.oracle import all_sql
from terrascore.plans.queries import all_queries

SF = os.environ.get("TERRASCORE_ORACLE_SF", "sf0.01")
SF_DIR = f"/root/testdata/{SF}"
QUERIES = all_queries()
ORACLE = all_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_statement_is_fast(con, name):
    began = time.perf_counter()
    con.sql(ORACLE[name]).fetchall()
    assert time.perf_counter() - began < 20


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    rep = compare(QUERIES[name](spark, SF_DIR), ORACLE[name], con)
    assert rep["ok"], rep


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "country_name" and "opportunity_rank" in df.columns
    ranks = [r["opportunity_rank"] for r in rows]
    assert ranks == sorted(ranks)
