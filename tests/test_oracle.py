"""Every query of the library proper against its SQL."""

import pytest

from lexiforge.plans import catalogue
from tests.oracle import DATA, assert_same

SMALL = str(DATA / "sf0.001")


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    assert_same(catalogue.queries()[name](spark, SMALL), catalogue.oracle_sql()[name], SMALL)


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_runs(spark, name):
    assert catalogue.queries()[name](spark, SMALL).count() >= 0


def test_entry_and_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
