"""The driver's contract."""

import __spark_entry__ as entry


def test_queries_and_sql():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) >= 230
    assert all(callable(f) for f in queries.values()) and all("select" in s.lower() for s in sql.values())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["trade_date", "daily_participation_state"] and df.count() > 1000
