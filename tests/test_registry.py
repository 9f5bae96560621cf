from pathlib import Path

import pytest

import __spark_entry__ as contract
from tools.check import compare

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["Boro", "Timestamp", "Vol"] and frame.count() > 0


def test_every_check_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, str(FOLDER), name).startswith(("same", "rows only"))
