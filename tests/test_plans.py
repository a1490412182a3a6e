"""Physical-plan properties the design relies on (checked on the formatted
plan, so a regression in pushdown, pruning or shuffle shape fails here)."""

import re

from conftest import SF_SMALL

import __spark_entry__ as E


def plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def exchanges(p):
    return re.findall(r"\(\d+\) Exchange\n", p)


def test_scan_pushdown_and_pruning(spark):
    p = plan(spark, "funnel_by_brand")
    # only the four used columns of events are read
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in p
    assert "value" not in re.search(r"ReadSchema: struct<ts[^\n]*", p).group(0)


def test_partial_aggregation_before_every_exchange(spark):
    for name in ("funnel_by_brand", "brand_age_metrics", "sliding_active_users"):
        p = plan(spark, name)
        tree = p.split("\n\n")[0]
        lines = [ln.strip(" :+-") for ln in tree.splitlines()]
        for i, ln in enumerate(lines):
            if ln.startswith("Exchange") and "hashpartitioning" in p:
                below = lines[i + 1] if i + 1 < len(lines) else ""
                assert below.startswith(("HashAggregate", "ObjectHashAggregate", "Project", "Sort",
                                         "WindowGroupLimit", "Filter")), (name, below)
        assert "Expand" not in p, name          # no distinct-aggregate expansion, no fan-out of events
        assert p.count("partial_") >= len(exchanges(p)) - 2, name


def test_window_fanout_after_minute_preaggregation(spark):
    tree = plan(spark, "sliding_product_views").split("\n\n")[0]
    lines = [ln.strip(" :+-") for ln in tree.splitlines()]
    i = next(k for k, ln in enumerate(lines) if ln.startswith("Expand"))
    assert lines[i + 1].startswith("HashAggregate")   # fan-out reads combined minute rows


def test_topk_limits_before_shuffle(spark):
    p = plan(spark, "recs_top10")
    tree = p.split("\n\n")[0]
    # WindowGroupLimit appears below and above the exchange on age_group
    assert tree.count("WindowGroupLimit") >= 2
    assert "hashpartitioning(age_group" in p


def test_bounded_lists_are_broadcast(spark):
    p = plan(spark, "brand_top100")
    assert re.search(r"BroadcastHashJoin LeftSemi BuildRight", p)
    p = plan(spark, "brand_user_metrics")
    assert "Window" not in p.split("\n\n")[0]     # dominant age group is an aggregate


def test_extremes_are_hash_aggregates(spark):
    """No sort of all rows for a first, last or dominant value: numbers are compared, winners fetched."""
    for name in ("first_per_product", "latest_snapshot", "top_products_latest", "recs_wide", "segment_activity",
                 "segment_product_stats", "brand_user_metrics", "brand_dominant_age", "distinct_counts"):
        p = plan(spark, name)
        assert "SortAggregate" not in p, name
        assert name != "distinct_counts" or "Expand" not in p


def test_distinct_users_without_fan_out(spark):
    for name in ("sliding_active_users", "sliding_purchases", "active_user_boxplot"):
        tree = plan(spark, name).split("\n\n")[0]
        assert "Expand" not in tree and "count(distinct" not in tree, name


def test_quantiles_hold_no_value_list(spark):
    for name in ("active_user_summary", "active_user_boxplot", "high_traffic_brands"):
        assert "percentile" not in plan(spark, name), name


def test_look_back_prunes_archive_hours(spark):
    for name in ("archive_funnel_24h", "archive_brand_7d"):
        assert "dynamicpruning" in plan(spark, name).lower(), name


def test_dimension_joins_carry_no_hint(spark):
    from clickflow.sources.tables import Tables
    t = Tables(spark, SF_SMALL)
    for df in (t.events(), t.order_events(), t.users()):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def test_window_summary_writes_no_events_away(spark):
    # three aggregates read the events (minutes, users, top lists); nothing as large as they is written,
    # and each leaves through exchanges that carry partial aggregates
    p = plan(spark, "window_summary")
    assert "SortAggregate" not in p
    tree = p.split("\n\n")[0]
    assert tree.count("Scan parquet") <= 12, tree.count("Scan parquet")


def test_no_catalogue_join_without_catalogue_columns(spark):
    for name in ("event_type_distribution", "events_per_hour", "events_lookback", "sliding_purchases",
                 "sliding_event_distribution", "segment_activity"):
        assert "part.parquet" not in plan(spark, name), name
