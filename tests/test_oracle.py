"""Every registered query against its DuckDB oracle (the driver's gate)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from oracle_check import compare, duck
from tidewatch.plans.queries import QUERIES

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) & set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF_ORACLE)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dataset_id", "win_start_ms", "win_end_ms", "winstart", "max_value", "min_value", "n"]
    assert SF_SMALL in E.SMOKE_DIR
