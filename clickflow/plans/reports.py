"""Report aggregates over the metric tables, as Spark queries.

Inputs are the batch metric tables (equal to the latest view of the live
store once the stream has caught up), the funnel records, the wide
recommendation rows and the brand records. Reports read the
non-overlapping windows (the 5-minute grid) of the sliding set, so sums do
not double count. Ratios divide with ``try_divide`` (NULL, not an error,
on a zero denominator); pandas-style "NaN to 0" uses ``coalesce``.
Quantiles are exact and linearly interpolated, by rank selection
(``clickflow.plans.quantiles``; the median of a top-15 list by ``median``), std is the
sample form. The least and greatest value needed by a second pass are scalar
subqueries, not joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.operators import sliding as sl
from clickflow.plans.joins import materialize
from clickflow.plans.quantiles import exact_quantiles
from clickflow.plans.serving import latest_by

# Report window step, histogram bins, box-plot whisker factor.
REPORT_STEP_MINUTES = 5
HIST_BINS = 10
WHISKER = 1.5


def _pct(num, den):
    return F.try_divide(F.col(num).cast("double") if isinstance(num, str) else num,
                        F.col(den) if isinstance(den, str) else den) * F.lit(100.0)


def report_windows(metric: DataFrame, step: int = REPORT_STEP_MINUTES) -> DataFrame:
    """The report's window grid: windows starting on the ``step``-minute grid
    (the non-overlapping 5-minute windows out of the 1-minute sliding set),
    i.e. whose start equals the start of their own ``step``-minute tumbling
    window."""
    grid = F.window(F.col("window_start"), f"{step} minutes").start.cast("timestamp_ntz")
    # the time-window rewrite adds a helper column; keep the input's columns
    return metric.filter(grid == F.col("window_start")).select(*metric.columns)


# --- realtime (R1-R7) -------------------------------------------------------

def active_user_summary(active: DataFrame) -> DataFrame:
    # one row per report window, read by the rank selection and the aggregate
    a = materialize(report_windows(active))
    median = exact_quantiles(a, "active_users", [0.5])[0.5]
    return a.agg(
        F.count(F.lit(1)).alias("windows"),
        F.avg("active_users").alias("mean_users"),
        F.max("active_users").alias("max_users"),
        F.min("active_users").alias("min_users"),
        F.lit(median).cast("double").alias("median_users"),
        F.round(F.stddev_samp("active_users"), 6).alias("std_users"),
        F.sum("total_events").alias("total_events"),
        F.try_divide(F.sum("total_events").cast("double"), F.sum("active_users")).alias("events_per_user"))


def active_user_boxplot(active: DataFrame) -> DataFrame:
    """Five-number summary with 1.5 IQR whiskers and the outlier count."""
    # one value per report window, read by the rank selection and the main
    # aggregate: materialised once so the events pipeline runs once
    a = materialize(report_windows(active).select(F.col("active_users").cast("double").alias("x")))
    q = exact_quantiles(a, "x", [0.25, 0.5, 0.75])
    q1, median, q3 = (F.lit(q[p]).cast("double") for p in (0.25, 0.5, 0.75))
    lo, hi = q1 - F.lit(WHISKER) * (q3 - q1), q3 + F.lit(WHISKER) * (q3 - q1)
    return a.agg(
        F.round(q1, 6).alias("q1"), F.round(median, 6).alias("median"), F.round(q3, 6).alias("q3"),
        F.min(F.when(F.col("x") >= lo, F.col("x"))).alias("lower_whisker"),
        F.max(F.when(F.col("x") <= hi, F.col("x"))).alias("upper_whisker"),
        F.count(F.when((F.col("x") < lo) | (F.col("x") > hi), F.lit(1))).alias("outliers"))


def active_user_histogram(spark: SparkSession, active: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    """Equal-width histogram (last bin closed): bin, lower, upper, center,
    label, count; every bin is listed, empty ones with 0."""
    a = materialize(report_windows(active).select(F.col("active_users").cast("double").alias("x")))
    mm = a.agg(F.min("x").alias("mn"), F.max("x").alias("mx"))
    mn0, mx0 = mm.select("mn").scalar(), mm.select("mx").scalar()
    same = mn0 == mx0
    lo = F.when(same, mn0 - F.lit(0.5)).otherwise(mn0)
    hi = F.when(same, mx0 + F.lit(0.5)).otherwise(mx0)
    idx = F.least(F.floor((F.col("x") - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1))
    counts = a.groupBy(idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # the bin list has a fixed size, so it is broadcast-bound
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    lower = lo + F.col("bin") * ((hi - lo) / F.lit(bins))
    upper = F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * ((hi - lo) / F.lit(bins)))
    return (all_bins.join(F.broadcast(counts), "bin", "left")
            .select("bin", lower.alias("lower"), upper.alias("upper"),
                    ((lower + upper) / 2).alias("center"),
                    F.concat_ws("-", lower.cast("bigint").cast("string"),
                                upper.cast("bigint").cast("string")).alias("label"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def brand_snapshots(events: DataFrame) -> DataFrame:
    """Latest activity row per (brand, event_type) over the report windows."""
    return latest_by(report_windows(sl.brand_activity(events)), ["brand", "event_type"], "window_start")


def brand_totals_top3(events: DataFrame) -> DataFrame:
    s = brand_snapshots(events)
    return (s.groupBy("brand").agg(F.sum("event_count").alias("event_count"),
                                   F.round(F.sum("total_value"), 2).alias("total_value"))
             .withColumn("value_per_event",
                         F.round(F.try_divide(F.col("total_value"), F.col("event_count")), 6))
             .orderBy(F.col("total_value").desc(), F.col("brand").asc()).limit(3))


def stage_conversion(distribution: DataFrame) -> DataFrame:
    d = report_windows(distribution)
    t = d.agg(*[F.coalesce(F.sum(F.when(F.col("event_type") == s, F.col("event_count"))),
                           F.lit(0).cast("bigint")).alias(f"{s}_events")
                for s in ("view", "cart", "purchase")])
    return t.select("view_events", "cart_events", "purchase_events",
                    _pct("cart_events", "view_events").alias("view_to_cart_pct"),
                    _pct("purchase_events", "cart_events").alias("cart_to_purchase_pct"),
                    _pct("purchase_events", "view_events").alias("view_to_purchase_pct"))


def purchase_totals(purchases: DataFrame) -> DataFrame:
    p = report_windows(purchases)
    return p.agg(F.count(F.lit(1)).alias("windows"),
                 F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
                 F.sum("purchase_count").alias("purchase_count"),
                 F.round(F.avg("avg_basket_value"), 6).alias("mean_basket_value"))


def top_products_latest(events: DataFrame, k: int = 10) -> DataFrame:
    s = latest_by(report_windows(sl.product_views(events)), ["product_id"], "window_start")
    return s.orderBy(F.col("view_count").desc(), F.col("product_id").asc()).limit(k)


# --- funnel (R8-R12) --------------------------------------------------------

def _active_funnel_rows(records: DataFrame) -> DataFrame:
    return records.filter((F.col("users_viewed") > 0) | (F.col("users_added_to_cart") > 0)
                          | (F.col("users_purchased") > 0))


def brand_funnel_top(records: DataFrame, k: int = 15) -> DataFrame:
    """Brand rows summed over runs, top k by viewers, with % rates."""
    b = _active_funnel_rows(records).filter(F.col("type") == "brand")
    s = b.groupBy("name").agg(*[F.sum(c).alias(c) for c in
                                ("users_viewed", "users_added_to_cart", "users_purchased")])
    return (s.orderBy(F.col("users_viewed").desc(), F.col("name").asc()).limit(k)
             .withColumn("v2c_rate", _pct("users_added_to_cart", "users_viewed"))
             .withColumn("c2p_rate", _pct("users_purchased", "users_added_to_cart")))


def funnel_totals(records: DataFrame) -> DataFrame:
    """Totals over category AND brand rows, stage conversion in %."""
    t = _active_funnel_rows(records).agg(
        *[F.sum(c).alias(c) for c in ("users_viewed", "users_added_to_cart", "users_purchased")])
    conv = lambda a, b: F.when(F.col(b) > 0, _pct(a, b)).otherwise(F.lit(0.0))
    return t.select("*", conv("users_added_to_cart", "users_viewed").alias("view_to_cart_pct"),
                    conv("users_purchased", "users_added_to_cart").alias("cart_to_purchase_pct"))


def view_to_cart_time(records: DataFrame, k: int = 10) -> DataFrame:
    """Mean view-to-cart seconds per brand, over all brands; the top k by time."""
    b = records.filter((F.col("type") == "brand") & (F.col("avg_view_to_cart_seconds") > 0))
    g = (b.groupBy("name").agg(F.avg("avg_view_to_cart_seconds").alias("avg_view_to_cart_seconds"),
                               F.sum("users_viewed").alias("users_viewed"),
                               F.sum("users_added_to_cart").alias("users_added_to_cart")))
    return (g.orderBy(F.col("avg_view_to_cart_seconds").desc(), F.col("name").asc()).limit(k))


def high_conversion_brands(records: DataFrame, min_viewed: int = 20, k: int = 5) -> DataFrame:
    t = brand_funnel_top(records)
    return (t.filter(F.col("users_viewed") >= min_viewed)
             .orderBy(F.col("v2c_rate").desc_nulls_last(), F.col("name").asc()).limit(k))


def rate_distribution(records: DataFrame) -> DataFrame:
    t = brand_funnel_top(records)
    return t.agg(F.round(F.avg("v2c_rate"), 6).alias("mean_v2c"),
                 F.round(F.median("v2c_rate"), 6).alias("median_v2c"),
                 F.max("v2c_rate").alias("max_v2c"), F.min("v2c_rate").alias("min_v2c"))


# --- recommendations (R13-R17) ------------------------------------------------

def _rank_entries(wide: DataFrame, fields: list[str], ranks: range) -> DataFrame:
    """Wide ``rank_<i>_<field>`` columns to one row per (segment, rank)."""
    entries = F.array(*[F.struct(F.lit(i).alias("rank"),
                                 *[F.col(f"rank_{i}_{f}").alias(f) for f in fields]) for i in ranks])
    return wide.select("age_group", F.inline(entries))


def most_recommended(wide: DataFrame, k: int = 20) -> DataFrame:
    e = _rank_entries(wide, ["product_name"], range(1, 11)).dropna(subset=["product_name"])
    return (e.groupBy("product_name").agg(F.count(F.lit(1)).alias("times"))
             .withColumn("label", F.substring("product_name", 1, 40))
             .orderBy(F.col("times").desc(), F.col("product_name").asc()).limit(k))


def rank_position_totals(wide: DataFrame) -> DataFrame:
    e = _rank_entries(wide, ["views", "add_to_cart", "purchases"], range(1, 11))
    return e.groupBy("rank").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("views", "add_to_cart", "purchases")])


def rank_decay(wide: DataFrame) -> DataFrame:
    t = rank_position_totals(wide)
    first = F.struct("views", "add_to_cart")
    r = t.agg(F.min_by(first, "rank").alias("f"), F.max_by(first, "rank").alias("l"))
    return r.select(F.col("f.views").alias("views_rank1"), F.col("l.views").alias("views_rank10"),
                    _pct(F.col("l.views"), F.col("f.views")).alias("views_decay_pct"),
                    F.col("f.add_to_cart").alias("cart_rank1"), F.col("l.add_to_cart").alias("cart_rank10"),
                    _pct(F.col("l.add_to_cart"), F.col("f.add_to_cart")).alias("cart_decay_pct"))


def age_group_top3(wide: DataFrame) -> DataFrame:
    """Most frequent product names in ranks 1-5 per age group (top 3) and
    the number of segment rows of the group (``wide`` feeds both, so it is
    materialised once)."""
    wide = materialize(wide)
    e = _rank_entries(wide, ["product_name"], range(1, 6)).dropna(subset=["product_name"])
    c = e.groupBy("age_group", "product_name").agg(F.count(F.lit(1)).alias("times"))
    w = Window.partitionBy("age_group").orderBy(F.col("times").desc(), F.col("product_name").asc())
    top = c.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= 3)
    segs = wide.groupBy("age_group").agg(F.count(F.lit(1)).alias("segments"))
    return top.join(segs, "age_group", "left")


def rank_ctr(wide: DataFrame) -> DataFrame:
    t = rank_position_totals(wide).withColumn(
        "ctr", F.coalesce(_pct("add_to_cart", "views"), F.lit(0.0)))
    r = t.agg(F.avg(F.when(F.col("rank") <= 3, F.col("ctr"))).alias("ctr_top3"),
              F.avg(F.when(F.col("rank") >= 8, F.col("ctr"))).alias("ctr_bottom3"))
    return r.select(F.round("ctr_top3", 6).alias("ctr_top3"),
                    F.round("ctr_bottom3", 6).alias("ctr_bottom3"),
                    F.round(F.col("ctr_top3") - F.col("ctr_bottom3"), 6).alias("ctr_diff"))


# --- brands (R18-R22) ---------------------------------------------------------

def brand_rollup(records: DataFrame) -> DataFrame:
    return records.groupBy("brand").agg(
        F.sum("total_views").alias("total_views"),
        F.sum("total_purchases").alias("total_purchases"),
        F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
        F.sum("unique_users").alias("unique_users"),
        F.round(F.avg("conversion_rate"), 6).alias("conversion_rate"))


BRAND_TOP_METRICS = ("total_revenue", "total_views", "conversion_rate", "total_purchases")


def brand_top10_by(records: DataFrame, k: int = 10) -> DataFrame:
    """Top k brands by each of revenue, views, conversion and purchases, as
    one long table (metric, position, brand, value)."""
    r = brand_rollup(records)
    longs = r.select("brand", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in BRAND_TOP_METRICS])))
    w = Window.partitionBy("metric").orderBy(F.col("value").desc(), F.col("brand").asc())
    return longs.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k)


def brand_arpu(records: DataFrame, k: int = 15) -> DataFrame:
    r = brand_rollup(records).withColumn(
        "arpu", F.round(F.coalesce(F.try_divide(F.col("total_revenue"), F.col("unique_users")),
                                   F.lit(0.0)), 6))
    return r.orderBy(F.col("arpu").desc(), F.col("brand").asc()).limit(k)


def brand_grand_totals(records: DataFrame) -> DataFrame:
    r = brand_rollup(records)
    return r.agg(F.count(F.lit(1)).alias("brands"),
                 F.round(F.sum("total_revenue"), 2).alias("total_revenue"),
                 F.sum("total_views").alias("total_views"),
                 F.sum("total_purchases").alias("total_purchases"),
                 F.round(F.avg("conversion_rate"), 6).alias("mean_conversion_rate"))


def high_traffic_brands(records: DataFrame) -> DataFrame:
    """Brands with views above the upper quartile: count, mean conversion."""
    r = materialize(brand_rollup(records))      # one row per brand
    q3 = exact_quantiles(r, "total_views", [0.75])[0.75]
    h = r.filter(F.col("total_views") > F.lit(q3).cast("double"))
    return h.agg(F.count(F.lit(1)).alias("brands"),
                 F.round(F.avg("conversion_rate"), 6).alias("mean_conversion_rate"))


# --- window summary (R23) -----------------------------------------------------

def window_summaries(events: DataFrame) -> DataFrame:
    """Every metric of each window in one row: users, events, purchases,
    events by type, top brand and product (rank 1 of the per-window lists),
    distinct brands in the brand top list and stage ratios.

    Sums and distinct users are running sums of differences (``window_totals``); only the
    two top lists expand rows into windows, both from one count per minute, product and
    event type."""
    totals = sl.window_totals(events)
    counts = sl.minute_counts(events)
    tb = sl.per_window_topk(sl.brand_counts(counts), "event_count", ["brand", "event_type"])
    # a window's list, ten rows at most
    entry = F.struct("rank", "brand", "event_type", "event_count")
    tbs = tb.groupBy("window_start").agg(F.sort_array(F.collect_list(entry)).alias("tb")).select(
        "window_start", F.size(F.array_distinct(F.transform("tb", lambda x: x["brand"]))).cast("bigint").alias("top_list_brands"),
        F.col("tb")[0]["brand"].alias("top_brand"), F.col("tb")[0]["event_type"].alias("top_brand_event_type"),
        F.col("tb")[0]["event_count"].alias("top_brand_events"))
    tp = sl.per_window_topk(sl.view_counts(counts), "view_count", ["product_id", "brand", "category_code"], 1).select(
        "window_start", F.col("product_id").alias("top_product_id"), F.col("view_count").alias("top_product_views"))
    s = totals.join(tbs, "window_start", "left").join(tp, "window_start", "left")
    none = lambda c: F.when(F.col(c) > 0, F.col(c))
    return s.select(
        "window_start", "window_end", "active_users", "total_events",
        F.coalesce(F.try_divide(F.col("total_events").cast("double"), F.col("active_users")),
                   F.lit(0.0)).alias("events_per_user"),
        F.col("purchase_events").alias("purchase_count"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        "avg_basket_value", "purchasing_users",
        *[f"{stage}_events" for stage in sl.STAGES], "top_brand", "top_brand_event_type", "top_brand_events",
        F.coalesce("top_list_brands", F.lit(0).cast("bigint")).alias("top_list_brands"),
        "top_product_id", "top_product_views",
        F.try_divide(none("cart_events").cast("double"), none("view_events")).alias("view_to_cart_ratio"),
        F.try_divide(none("purchase_events").cast("double"), none("cart_events")).alias("cart_to_purchase_ratio"))
