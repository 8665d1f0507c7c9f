import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = {r.stage: r.value for r in df.collect()}
    assert rows["original"] == 200
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
