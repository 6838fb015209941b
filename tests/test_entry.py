import __spark_entry__ as E
from candlewick.plans.queries import QUERIES


def test_registry_and_oracles_align():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == set()  # every query of the library itself has an oracle


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "severity" in df.columns and "breaker_state" in df.columns
