"""Every registered query against its SQL, or at least for rows and a stable schema."""

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from caseloom.registry import ORACLES, QUERIES

# Fits that take minutes on a small machine; their parts are tested in test_text and test_ml.
SLOW = {"lda_quality", "feature_importance", "gbt_evaluation", "forecast_components"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
    assert len(contract.queries()) > 150


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, folder, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], folder) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows_only(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)
