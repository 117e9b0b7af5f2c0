import __spark_entry__ as entry


def test_sql_has_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 60


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "chunks"] and df.limit(1).count() == 1
