"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.comparing import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_its_twin(spark, duck, name):
    assert differences(spark, duck, SF_DIR, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_the_flagship_query_returns_rows(spark):
    assert entry.entry(spark).count() == 166
