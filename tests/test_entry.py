import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "property_id" in df.columns


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert len(q) >= 100
    assert set(o) <= set(q)
