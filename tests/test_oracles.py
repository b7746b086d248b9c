"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import pytest

from oracle import compare, connect
from panelforge.workload.oracles import ORACLES
from panelforge.workload.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), ORACLES[name], con) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
