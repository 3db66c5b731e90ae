"""Every registered query of the privacy jobs gives the rows of its SQL."""

import pytest

from shroud.plans import catalog
from tests.support import duck_rows, engine, spark_rows


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_same_rows_as_sql(spark, sf_dir, name):
    got = spark_rows(catalog.queries()[name](spark, sf_dir))
    want = duck_rows(engine(sf_dir), catalog.oracle_sql()[name])
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
