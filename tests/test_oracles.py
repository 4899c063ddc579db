"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from stationlake.plans.registry import REGISTRY
from tests.oracle_util import compare, duck

KEYS = sorted(REGISTRY)  # the training-data queries are tested in tests/llm
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    assert set(KEYS) == set(ORACLES) & set(KEYS)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "yearly_avg_temp" in df.columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    if key in ORACLES:
        compare(df, con, ORACLES[key])
    else:
        assert df.count() > 0
