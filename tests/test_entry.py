"""Driver contract: entry runs; every query with SQL has a callable and vice versa."""

import __spark_entry__ as entry_mod


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"feature", "value", "pos", "neg", "woe"}


def test_registry_consistent():
    qs = entry_mod.queries()
    sql = entry_mod.oracle_sql()
    assert len(qs) >= 80
    assert set(sql) <= set(qs)
    for name in qs:
        assert name == name.strip() and name
