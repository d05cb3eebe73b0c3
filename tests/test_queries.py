"""Every registered query against its SQL, exactly."""

import pytest

import __spark_entry__ as entry
from checks.compare import differences, tables
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return tables(FOLDER)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry.queries().keys()


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns[:3] == ["timestamp", "id", "city"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    result = entry.queries()[name](spark, FOLDER)
    assert differences(result, con, entry.oracle_sql()[name]) == []
