"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, duck, name):
    problem, count = compare(spark, duck, SF, name, entry.queries()[name], ORACLE.get(name))
    assert not problem and count > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 36
    assert set(ORACLE) <= set(entry.queries())


def test_golden_counts(spark):
    """Known numbers of the bitext views at this scale."""
    counts = {row["split"]: row["records"] for row in entry.queries()["split_counts"](spark, SF).collect()}
    assert counts == {"train": 502, "val": 59, "test": 73}
    assert entry.queries()["dedup_pairs"](spark, SF).count() == 317
