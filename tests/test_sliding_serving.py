import datetime as dt

import pytest

from pyspark.sql import functions as F

from conftest import make_events, ts

from clickflow.operators import sliding as sl
from clickflow.plans import serving as sv


def test_window_edges_five_windows(spark):
    # window_edges: an event exactly on a minute boundary lands in 5 windows
    ev = make_events(spark, [(1, "2024-01-01 10:07:00", 1, "view", 1, "c", "b", 1)])
    got = sorted(r.window_start for r in sl.active_users(ev).collect())
    assert got == [ts(f"2024-01-01 10:0{m}:00") for m in range(3, 8)]
    ends = {r.window_start: r.window_end for r in sl.active_users(ev).collect()}
    assert all(e - s == dt.timedelta(minutes=5) for s, e in ends.items())


def test_batch_and_stream_forms_agree(spark):
    rows = [(i, f"2024-01-01 10:{i % 12:02d}:{(7 * i) % 60:02d}", i % 4, ["view", "cart", "purchase"][i % 3],
             i % 5, "c", "b" if i % 2 else None, i) for i in range(1, 60)]
    ev = make_events(spark, rows)
    for f in (sl.product_views, sl.purchases, sl.event_distribution, sl.brand_activity):
        a = f(ev, mode="batch").drop("avg_price", "avg_basket_value", "total_value", "total_revenue")
        b = f(ev, mode="stream").drop("avg_price", "avg_basket_value", "total_value", "total_revenue",
                                       "purchasing_users")
        a = a.drop("purchasing_users")
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), f.__name__
    au = sorted((r.window_start, r.active_users, r.total_events) for r in sl.active_users(ev).collect())
    ap = sorted((r.window_start, r.active_users, r.total_events) for r in sl.active_users_approx(ev).collect())
    assert au == ap   # tiny groups: the approximate count is exact


def test_per_window_topk_ties(spark):
    rows = [(i, "2024-01-01 10:00:00", i, "view", 100 - i, "c", "b", 1) for i in range(1, 13)]
    top = sl.top_products(make_events(spark, rows))
    w = top.filter(F.col("window_start") == ts("2024-01-01 10:00:00")).orderBy("rank").collect()
    assert len(w) == 10
    assert [r.product_id for r in w] == list(range(88, 98))


def test_version_log_latest_and_replay(spark, scratch):
    store = sv.VersionLog(spark, scratch + "/store")
    base = spark.createDataFrame(
        [(ts("2024-01-01 10:00:00"), 5), (ts("2024-01-01 10:01:00"), 7)],
        "window_start TIMESTAMP_NTZ, active_users BIGINT").withColumn("row_key", sv.row_key("active_users"))
    store.write(base, "active_users", "r1", 0, F.lit(ts("2024-01-01 10:10:00")))
    upd = base.filter(F.col("active_users") == 5).withColumn("active_users", F.lit(6).cast("bigint"))
    store.write(upd, "active_users", "r1", 1, F.lit(ts("2024-01-01 10:11:00")))
    # epoch_replay: epoch 1 written again, nothing duplicates
    store.write(upd, "active_users", "r1", 1, F.lit(ts("2024-01-01 10:11:00")))
    assert store.read("active_users").count() == 3
    latest = {r.row_key: r.active_users for r in store.latest("active_users").collect()}
    assert latest == {"20240101_1000_active_users": 6, "20240101_1001_active_users": 7}
    scan = store.scan("active_users", "20240101_1001").collect()
    assert [r.row_key for r in scan] == ["20240101_1001_active_users"]
    assert sv.retain(store.read("active_users"), 1).count() == 2


def test_latest_tie_uses_epoch_and_key_kinds(spark):
    v = spark.createDataFrame(
        [("k", ts("2024-01-01 10:00:00"), 0, 1), ("k", ts("2024-01-01 10:00:00"), 1, 2)],
        "row_key STRING, created_at TIMESTAMP_NTZ, epoch_id BIGINT, v INT")
    assert sv.latest(v).collect()[0].v == 2
    keys = spark.createDataFrame(
        [("x_active_users",), ("x_purchases",), ("x_event_purchase",), ("x_event_view",),
         ("x_brand_acme_view",), ("x_top_view_5",)], "k STRING")
    got = [r.m for r in keys.select(sv.metric_from_key(F.col("k")).alias("m")).collect()]
    assert got == ["active_users", "purchases", "event_purchase", "event_view", "brand", "top_view"]


def test_version_log_compaction(spark, scratch):
    store = sv.VersionLog(spark, scratch + "/store")
    base = spark.createDataFrame([(ts("2024-01-01 10:00:00"), 1)],
                                 "window_start TIMESTAMP_NTZ, active_users BIGINT") \
        .withColumn("row_key", sv.row_key("active_users"))
    for e in range(4):
        store.write(base.withColumn("active_users", F.lit(e).cast("bigint")), "active_users", "r", e,
                    F.lit(ts(f"2024-01-01 10:1{e}:00")))
    compacted = store.compact("active_users", 2, scratch + "/store2")
    kept = sorted(r.active_users for r in compacted.read("active_users").collect())
    assert kept == [2, 3]
    assert compacted.latest("active_users").collect()[0].active_users == 3
    assert store.read("active_users").count() == 4          # source untouched


def test_one_pass_metrics_equal_single_metrics(spark):
    # nulls in every key, NULL prices, a NULL time, two events in one minute
    rows = [(1, "2024-01-01 10:00:10", 1, "view", 1, "c", "b", 2.0),
            (2, "2024-01-01 10:00:50", 1, "purchase", 1, "c", "b", 3.5),
            (3, "2024-01-01 10:02:00", None, "view", None, None, None, None),
            (4, "2024-01-01 10:03:00", 2, "cart", 2, None, "b", 1.0),
            (5, "2024-01-01 10:04:59", 2, "purchase", 2, "d", None, None),
            (6, None, 3, "view", 3, "c", "b", 1.0)]
    ev = make_events(spark, rows)
    from clickflow.plans import reports as rp
    au = {r.window_start: r for r in sl.active_users(ev).collect()}
    pu = {r.window_start: r for r in sl.purchases(ev).collect()}
    mix = {}
    for r in sl.event_distribution(ev).collect():
        mix.setdefault(r.window_start, {})[r.event_type] = r.event_count
    totals = {r.window_start: r for r in sl.window_totals(ev).collect()}
    assert set(totals) == set(au) == set(mix)
    for w, t in totals.items():
        assert (t.active_users, t.total_events) == (au[w].active_users, au[w].total_events)
        p = pu.get(w)
        assert (t.purchase_events, t.purchasing_users) == ((p.purchase_count, p.purchasing_users) if p else (0, 0))
        assert (t.total_revenue, t.avg_basket_value) == ((p.total_revenue, p.avg_basket_value) if p else (None, None))
        assert all(getattr(t, f"{s}_events") == mix[w].get(s, 0) for s in sl.STAGES)
    counts = sl.minute_counts(ev)
    key = ["window_start", "product_id", "brand", "category_code", "view_count"]
    assert sorted(map(repr, sl.view_counts(counts).select(key).collect())) == sorted(
        map(repr, sl.product_views(ev).select(key).collect()))
    key = ["window_start", "brand", "event_type", "event_count"]
    assert sorted(map(repr, sl.brand_counts(counts).select(key).collect())) == sorted(
        map(repr, sl.brand_activity(ev).select(key).collect()))
    assert rp.window_summaries(ev).count() == len(au)


def test_interval_deltas_equal_count_distinct(spark):
    """Runs of a user's minutes: gaps of exactly and beyond a window, across midnight, repeated
    minutes, users without id, times before 1970."""
    minutes = ["2023-12-31 23:54", "2023-12-31 23:58", "2023-12-31 23:59", "2024-01-01 00:00", "2024-01-01 00:05",
               "2024-01-01 00:06", "2024-01-01 00:12", "2024-01-01 00:18", "2024-01-03 00:00", "1969-12-31 23:58"]
    rows = [(i, f"{m}:{i % 60:02d}", u, "purchase" if (i + (u or 0)) % 3 else "view", 1, "c", "b", 1.5 if i % 2 else None)
            for i, m in enumerate(minutes * 2) for u in (1, 2, None, 3 + i % 4)]
    ev = make_events(spark, rows)
    want = {}
    for r in rows:
        if r[3] == "purchase":
            m = ts(r[1]).replace(second=0)
            for k in range(5):
                want.setdefault(m - dt.timedelta(minutes=k), []).append(r)
    got = {r.window_start: r for r in sl.purchases(ev).collect()}
    assert set(got) == set(want)
    for w, rs in want.items():
        prices = [r[7] for r in rs if r[7] is not None]
        assert got[w].purchase_count == len(rs) and got[w].window_end == w + dt.timedelta(minutes=5)
        assert got[w].purchasing_users == len({r[2] for r in rs} - {None})
        assert got[w].total_revenue == (sum(prices) if prices else None)
    au = {r.window_start: (r.active_users, r.total_events) for r in sl.active_users(ev).collect()}
    assert len(au) >= len(got) and all(au[w][1] >= got[w].purchase_count for w in got)
    assert sl.active_users(ev.limit(0)).count() == 0


def test_sketches_merge_into_windows(spark):
    rows = [(i, f"2024-01-01 10:{i % 7:02d}:00", i * 7919 % 5000, "view", 1, "c", "b", 1) for i in range(20000)]
    ev = make_events(spark, rows)
    out = sl.active_users_approx(ev).collect()
    assert len(out) == 11 and all(r.estimate_in_bound for r in out)
    assert any(r.estimate != r.active_users for r in out)      # an estimate, not the count
    sketches = sl.minute_sketches(ev)
    assert sketches.count() == 7
    merged = {r.window_start: r.estimate for r in sl.active_users_from_sketches(sketches).collect()}
    assert {r.window_start: r.estimate for r in out} == merged


def test_bitmap_distinct_counts(spark):
    from clickflow.operators import profile as pf
    rows = [(1, "2024-01-01 10:00:00", 1, "view", 32767, "c", "b", 1), (2, "2024-01-01 10:00:00", 32768, "view", 32768, "c", None, 1),
            (3, "2024-01-01 10:00:00", 1, "view", None, None, "b", 1), (4, "2024-01-01 10:00:00", None, "view", 0, "d", "", 1),
            (5, "2024-01-01 10:00:00", 10 ** 12, "view", 0, "d", "b2", 1), (6, "2024-01-01 10:00:00", -1, "view", 63, "d", "b2", 1)]
    r = pf.distinct_counts(make_events(spark, rows)).collect()[0]
    assert (r.products, r.categories, r.users, r.brands, r.events) == (4, 2, 4, 3, 6)
    e = pf.distinct_counts(make_events(spark, rows).limit(0)).collect()[0]
    assert (e.products, e.categories, e.users, e.brands, e.events) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize("few", [0, 4096])
def test_exact_quantiles(spark, few, monkeypatch):
    import numpy as np
    from clickflow.plans import quantiles
    monkeypatch.setattr(quantiles, "FEW", few)     # by ranges, and by a bounded list
    from clickflow.plans.quantiles import exact_quantiles, placed_values
    rng = np.random.default_rng(1)
    for xs in ([3.0], [1.0, 2.0], [5.0] * 9, list(rng.normal(size=501)), [0.0] * 1000 + list(rng.exponential(size=77))):
        df = spark.createDataFrame([(float(x),) for x in xs] + [(None,)], "x DOUBLE").repartition(5)
        got = exact_quantiles(df, "x", [0, 0.25, 0.5, 0.75, 1])
        assert all(abs(v - np.quantile(xs, q)) < 1e-12 for q, v in got.items())
        assert placed_values(df, "x").agg(F.sum("n")).first()[0] == len(xs)
    assert exact_quantiles(spark.createDataFrame([], "x DOUBLE"), "x", [0.5]) == {0.5: None}


def test_extreme_rows(spark):
    from clickflow.plans.joins import extreme_rows
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 2, "z"), (None, 1, "n"), (None, 3, "m"), (2, None, "x")],
                               "k INT, o INT, v STRING")
    rows = lambda newest: sorted((r.k is None, r.k, r.o, r.v) for r in
                                 extreme_rows(df, ["k"], F.col("o"), newest).collect())
    assert rows(True) == [(False, 1, 5, "a"), (True, None, 3, "m")]
    assert rows(False) == [(False, 1, 2, "z"), (True, None, 1, "n")]
