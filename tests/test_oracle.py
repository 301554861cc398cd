"""Every query with an SQL counterpart gives the same columns, types and rows as DuckDB."""

import pytest

from tallyloom.plans import sizing, skew

from tallyloom.queries import REGISTRY
from tests.oracle import difference


LARGE = [
    "price_drift", "orders_only_match", "customers_in_tvf", "customers_all_match", "country_store_ratio", "yoy_customers",
    "orders_by_weekday", "hidden_gems", "pair_cooccurrence", "split_stratified", "split_two_way", "box_stats", "cum_drop",
    "pair_titles",
]


@pytest.mark.parametrize("name", LARGE)
def test_matches_sql_when_nothing_fits(spark, sf_dir, monkeypatch, name):
    """The plans for large sides: no broadcast by size, small summaries refused, every key heavy from 20 rows on."""
    monkeypatch.setattr(skew.heavy_keys, "__defaults__", (20,))
    monkeypatch.setattr(skew.spread_join, "__defaults__", ("inner", 20))
    monkeypatch.setattr(sizing.settled, "__defaults__", (0,))
    monkeypatch.setattr(sizing.Summary.__init__, "__defaults__", (0,))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    q = REGISTRY[name]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert difference(spark, q.run, q.sql, sf_dir) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_matches_sql(spark, sf_dir, name):
    q = REGISTRY[name]
    assert difference(spark, q.run, q.sql, sf_dir) is None
