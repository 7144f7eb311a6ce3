import os

import pytest

import __spark_entry__ as e

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")
def test_flagship(spark):
    assert e.entry(spark).count() == 1


def test_names():
    assert set(e.oracle_sql()) <= set(e.queries())
