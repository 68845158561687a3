"""Every query of the engine's own operators against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from attesta.plans import registry
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_equals_sql(spark, duck, name):
    check(registry.QUERIES[name](spark, SF), registry.ORACLE[name], duck)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
