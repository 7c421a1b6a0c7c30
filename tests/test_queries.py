"""Every query of the catalogue against its SQL."""

import os

import pytest
from conftest import duck, same_rows

from prismarq.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    if name in catalogue.SQL:
        same_rows(got, duck(SF).execute(catalogue.SQL[name]).fetch_df())
    assert len(got)


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
