"""Every query with SQL agrees with it on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, duck

from checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def database(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees(spark, database, sf_dir, name):
    assert compare(spark, database, sf_dir, name, QUERIES[name], ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
