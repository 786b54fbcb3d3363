import __spark_entry__ as E
from helpers import SF_SMALL


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 21


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "num_order" in df.columns
