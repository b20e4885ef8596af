"""Every registered query against its independent DuckDB oracle (sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, (decimal.Decimal, float)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(set(E.queries()) - E.training_data_keys()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SMOKE)
    res = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, df.collect()) == _rows(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_registered_queries_pin_the_session_zone(spark):
    """date(ts) and timestamptz casts are defined in UTC; a caller's other zone is overridden."""
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        E.queries()["location_checkout_counts"](spark, SMOKE)
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
