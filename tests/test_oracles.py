"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from conftest import TESTDATA
from oracle import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from gildmill.queries import ORACLES, QUERIES

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


# Approximate neighbours and learned vectors: tested against NumPy and exact search instead.
WITHOUT_SQL = {"search_topk_approximate", "latent_search"}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL
    assert queries().keys() >= QUERIES.keys() and oracle_sql().keys() >= ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert difference(spark, duck, FOLDER, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    assert entry(spark).columns[0] == "id"
