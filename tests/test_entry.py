import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert "doses_per_1000_people" in df.columns
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
