import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    rows, diff = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert not diff, diff
    assert rows > 0


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
