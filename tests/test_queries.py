"""Every registered query against its SQL twin, or for shape where it has none."""

import os

import pytest

import oracle
from marketspark.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Boosting fits hundreds of rounds, each of several jobs; they run in the slow set only, smaller ones in test_learners.
SLOW = {"m8_gradient_boosting", "m9_boosted_trees"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    if name in SLOW and not os.environ.get("TEST_SLOW"):
        pytest.skip("set TEST_SLOW to run")
    assert QUERIES[name](spark, SF_DIR).count() > 0
