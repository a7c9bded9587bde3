"""Every query with an oracle matches DuckDB on the driver tables (sf0.001)."""

import os
import sys

import pytest

from tests.conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import compare, duck  # noqa: E402

from jobsight.plans.catalog import QUERIES  # noqa: E402

KEYS = sorted(set(E.oracle_sql()) & set(QUERIES))


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert not missing, missing


@pytest.mark.parametrize("key", KEYS)
def test_parity(spark, con, key):
    ok, detail = compare(E.queries()[key](spark, SF_SMALL), con, E.oracle_sql()[key])
    assert ok, detail


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["id", "area_id", "area_name"] and len(df.columns) == 32
    assert df.count() > 0
