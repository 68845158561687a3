"""The registered queries run over the tables, and equal their SQL where they have one."""

from __future__ import annotations

import pytest

from attesta.llm import queries
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    check(queries.QUERIES[name](spark, SF), queries.ORACLE[name], connect(SF))


def test_ten():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
