"""Driver contract: entry runs, every oracle key is a query, and a sample of
queries equals its DuckDB oracle on the smallest tables."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as E
from oracle_check import compare, duck

SAMPLE = ["funnel_by_brand", "funnel_union", "recs_top10", "brand_age_metrics",
          "brand_user_metrics", "order_brand_age_metrics", "sliding_active_users",
          "sliding_top_brands", "zip_join", "extend_ids", "active_user_histogram",
          "brand_top10_by", "window_summary", "user_demographics", "users_csv_readback", "products_readback",
          "serving_prefix_scan", "window_key_events", "normalised_events", "coerced_numbers", "named_products",
          "recommended_items", "views_top10", "order_daily_top_products", "order_daily_top_brands",
          "order_brand_top5"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "users_viewed" in df.columns


def test_oracle_keys_are_queries():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 85


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, con)
    assert r["cols_match"], r
    assert r["ok"], r
