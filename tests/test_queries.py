"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import difference, duck

from textkg.plans import load_all

SF_DIR = "/root/testdata/sf0.001"
CATALOG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(CATALOG.ORACLES))
def test_matches_sql(spark, con, name):
    assert difference(CATALOG.QUERIES[name](spark, SF_DIR), con, CATALOG.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(CATALOG.QUERIES) - set(CATALOG.ORACLES)))
def test_runs_without_sql(spark, name):
    assert CATALOG.QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == [
        "subject_class", "subject", "predicate", "object", "object_class",
    ]
