"""Every registered query beside its SQL, as the driver runs them, and reruns of those without SQL."""

from __future__ import annotations

import pytest
from compare import differences, duck

from cladeworks.plans import catalog


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_against_sql(spark, sf_dir, con, name):
    assert differences(catalog.queries()[name](spark, sf_dir), con, catalog.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in catalog.oracle_sql()])
def test_repeatable(spark, sf_dir, name):
    rows = lambda: sorted(map(repr, catalog.queries()[name](spark, sf_dir).collect()))
    found = rows()
    assert found and found == rows()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
