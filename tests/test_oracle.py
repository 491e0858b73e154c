"""Every query against DuckDB on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from eventmart.plans import oracles
from eventmart.plans import queries as catalog
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert catalog.queries().keys() == oracles.oracle_sql().keys()


@pytest.mark.parametrize("name", catalog.queries())
def test_query(spark, sf_dir, db, name):
    count, ours, theirs = compare(catalog.queries()[name](spark, sf_dir), db, oracles.oracle_sql()[name])
    assert not ours and not theirs
    assert count > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
