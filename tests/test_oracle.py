"""Every driver query against its DuckDB SQL twin."""

import pytest

from oracle_harness import compare, duck
from trimatch.plans.oracles import ORACLES
from trimatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["ok"], r


def test_entry_contract(spark):
    import __spark_entry__ as e
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(e.queries()) and set(ORACLES) <= set(e.oracle_sql()) <= set(e.queries())
    df = e.entry(spark)
    rows = {r["category"]: r["n_rows"] for r in df.collect()}
    assert rows["全部数据"] == 2115
