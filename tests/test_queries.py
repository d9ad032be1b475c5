import pytest

from conftest import DATA
from helpers import duck, same
from veriloom.plans import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, DATA)
    if name in ORACLES:
        same(df, duck(DATA).execute(ORACLES[name]).fetch_df())
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
