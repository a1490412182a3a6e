import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from conftest import make_events, ts

from clickflow.functions import clean, timefns
from clickflow.operators import dims
from clickflow.plans import reports as rp


def test_clean_events_null_dims(spark):
    # events_null_dims: '' and 'NaN' labels, empty price, empty / bad ids
    raw = spark.createDataFrame(
        [("2019-12-01 10:00:00 UTC", "view", "5", "1", "", "NaN", "", "7", "s"),
         ("2019-12-27T08:30:15", "cart", "x", "1", "tv", "acme", "2.5", "", "s"),
         ("bad time", "view", "", "1", "NaN", "", "1", "8", "s")],
        "event_time STRING, event_type STRING, product_id STRING, category_id STRING, "
        "category_code STRING, brand STRING, price STRING, user_id STRING, user_session STRING")
    r = clean.clean_events(raw).collect()
    assert r[0].category_code is None and r[0].brand is None and r[0].price == 0.0
    assert r[0].event_timestamp == ts("2019-12-01 10:00:00") and r[0].product_id == 5
    assert r[1].product_id is None and r[1].user_id is None and r[1].price == 2.5
    assert r[1].event_timestamp == ts("2019-12-27 08:30:15")
    assert r[2].event_timestamp is None and r[2].category_code is None


def test_remap_days(spark):
    # remap_days: days 1, 26, 27, 31 of December
    df = spark.createDataFrame([(ts(f"2019-12-{d:02d} 13:45:30.5"),) for d in (1, 26, 27, 31)],
                               "t TIMESTAMP_NTZ")
    got = [r.m for r in df.select(timefns.remap_replay_time(F.col("t"), 2025).alias("m")).collect()]
    assert got == [ts("2026-01-01 13:45:30.5"), ts("2026-01-26 13:45:30.5"),
                   ts("2025-12-27 13:45:30.5"), ts("2025-12-31 13:45:30.5")]


def test_lookback_bounds(spark):
    # lookback_bounds: exactly at as_of, as_of - 24 h, after as_of
    ev = make_events(spark, [(1, "2024-01-31 00:00:00", 1, "view", 1, "c", "b", 1),
                             (2, "2024-01-30 00:00:00", 1, "view", 1, "c", "b", 1),
                             (3, "2024-01-29 23:59:59", 1, "view", 1, "c", "b", 1),
                             (4, "2024-01-31 00:00:01", 1, "view", 1, "c", "b", 1)])
    closed = {r.event_id for r in timefns.events_between(ev, dt.datetime(2024, 1, 31), 24).collect()}
    open_ = {r.event_id for r in timefns.events_since(ev, dt.datetime(2024, 1, 31), 1).collect()}
    assert closed == {1, 2}
    assert open_ == {1, 2, 4}


def test_window_keys_and_labels(spark):
    k = timefns.window_keys(spark, "20191230_1600", "20191230_1610", 5).collect()
    assert [r.window_key for r in k] == ["20191230_1600", "20191230_1605", "20191230_1610"]
    lab = spark.createDataFrame([("20191230_1600_active_users",)], "k STRING") \
        .select(timefns.key_label(F.col("k")).alias("l")).collect()[0].l
    assert lab == "16:00 30.12.2019"


def test_zip_unequal_and_keep_first(spark):
    ids = spark.createDataFrame([(i,) for i in (50, 10, 40, 20, 30)], "user_id BIGINT")
    prof = spark.createDataFrame([("c", 3), ("a", 1), ("b", 2)], "name STRING, k INT")
    z = sorted(dims.zip_frames(ids, ["user_id"], prof, ["k"]).collect(), key=lambda r: r.user_id)
    assert [(r.user_id, r.name) for r in z] == [(10, "a"), (20, "b"), (30, "c"), (40, None), (50, None)]
    # dup_products: product twice with different category, keep the first by order
    p = spark.createDataFrame([(1, "tv", 2), (1, "radio", 1), (2, "x", 5)],
                              "product_id BIGINT, category STRING, seq INT")
    f = {r.product_id: r.category for r in dims.first_per_key(p, "product_id", "seq", ["category"]).collect()}
    assert f == {1: "radio", 2: "x"}
    e = dims.extend_ids(spark, spark.createDataFrame([(3,), (7,)], "user_id BIGINT"), 5)
    assert sorted(r.user_id for r in e.collect()) == [3, 7, 8, 9, 10]


def _active(spark, values):
    return spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=5 * i), v, 2 * v) for i, v in enumerate(values)],
        "window_start TIMESTAMP_NTZ, active_users BIGINT, total_events BIGINT")


def test_boxplot_and_histogram_against_numpy(spark):
    vals = [3, 7, 8, 5, 12, 14, 21, 13, 18, 60]
    a = _active(spark, vals)
    b = rp.active_user_boxplot(a).collect()[0]
    q1, med, q3 = np.percentile(vals, [25, 50, 75])
    assert (b.q1, b.median, b.q3) == (round(q1, 6), round(med, 6), round(q3, 6))
    assert b.outliers == 1 and b.upper_whisker == 21.0 and b.lower_whisker == 3.0
    counts, edges = np.histogram(vals, bins=10)
    h = sorted(rp.active_user_histogram(spark, a).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in h] == list(counts)
    assert [r.lower for r in h] == list(edges[:-1])
    flat = rp.active_user_histogram(spark, _active(spark, [4, 4, 4])).collect()
    assert sum(r["count"] for r in flat) == 3 and min(r.lower for r in flat) == 3.5


def test_summary_only_report_windows(spark):
    a = _active(spark, [1, 2, 3]).unionByName(
        spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 1), 100, 100)],
                              "window_start TIMESTAMP_NTZ, active_users BIGINT, total_events BIGINT"))
    s = rp.active_user_summary(a).collect()[0]
    assert s.windows == 3 and s.max_users == 3 and s.events_per_user == 2.0


def test_wide_rank_reports(spark):
    cols = {}
    for i in range(1, 11):
        cols[f"rank_{i}_product_name"] = f"p{i}" if i < 9 else None
        cols[f"rank_{i}_views"] = 100 - 10 * i
        cols[f"rank_{i}_add_to_cart"] = 10 - i
        cols[f"rank_{i}_purchases"] = 1
    names = ["age_group"] + list(cols)
    ddl = ", ".join(f"{n} STRING" if n.endswith("name") or n == "age_group" else f"{n} BIGINT"
                    for n in names)
    wide = spark.createDataFrame([tuple([g] + list(cols.values())) for g in ("18-24", "25-34")], ddl)
    mr = rp.most_recommended(wide).collect()
    assert len(mr) == 8 and all(r.times == 2 for r in mr)
    d = rp.rank_decay(wide).collect()[0]
    assert d.views_rank1 == 180 and d.views_rank10 == 0 and d.views_decay_pct == 0.0
    t = {r["rank"]: r.views for r in rp.rank_position_totals(wide).collect()}
    assert t[1] == 180 and len(t) == 10
    top = rp.age_group_top3(wide).collect()
    assert len(top) == 6 and {r.segments for r in top} == {1}
