"""Every registered query against its DuckDB oracle (sf0.001), the way the driver checks sf0.01."""

import os

import pytest

from tests.oracle_harness import compare, duck

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def _names():
    from innsight.plans.registry import QUERIES, load_all

    load_all()  # the training-data queries have their tests in tests/llm
    return sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF)
    assert res["status"] in ("ok", "rows-only"), res


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() >= 0 and len(df.columns) > 5
