"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables of ``sf_dir`` (through the adapter in
``clickflow.sources.tables``) over their whole extent. ``AS_OF`` is the fixed
evaluation time (the driver events end on 2024-01-30); look-back queries use
``LOOKBACK_AS_OF``, the end of the log, with the jobs' own 24 h default.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.operators import brands as br
from clickflow.operators import dims
from clickflow.operators import funnel as fn
from clickflow.operators import profile as pf
from clickflow.operators import recommend as rc
from clickflow.operators import sliding as sl
from clickflow.functions.timefns import events_between, ntz_lit, window_keys
from clickflow.plans.joins import materialize
from clickflow.sources.tables import Tables

AS_OF = dt.datetime(2024, 2, 1)
LOOKBACK_AS_OF = dt.datetime(2024, 1, 31)
RUN_ID = AS_OF.strftime("%Y%m%d_%H%M%S")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(f: Query) -> Query:
        QUERIES[name] = f
        return f
    return deco


# --- funnel -----------------------------------------------------------------

@register("funnel_user_product")
def funnel_user_product(spark, sf):
    return fn.first_touch(Tables(spark, sf).events())


@register("funnel_by_category")
def funnel_by_category(spark, sf):
    return fn.funnel_by_category(Tables(spark, sf).events())


@register("funnel_by_brand")
def funnel_by_brand(spark, sf):
    return fn.funnel_by_brand(Tables(spark, sf).events())


@register("funnel_union")
def funnel_union(spark, sf):
    return fn.funnel_records(Tables(spark, sf).events(), RUN_ID, AS_OF)


@register("funnel_lookback")
def funnel_lookback(spark, sf):
    """Brand funnel of the closed 24 h look-back ending at the log end."""
    ev = events_between(Tables(spark, sf).events(), LOOKBACK_AS_OF, hours=24)
    return fn.funnel_by_brand(ev)


# --- recommendations --------------------------------------------------------

def _segments(t: Tables):
    return rc.user_segments(t.users(), AS_OF)


@register("segment_activity")
def segment_activity(spark, sf):
    t = Tables(spark, sf)
    return rc.segment_activity(t.plain_events(), _segments(t))


@register("segment_product_stats")
def segment_product_stats(spark, sf):
    t = Tables(spark, sf)
    return rc.segment_product_stats(t.plain_events(), _segments(t))


@register("recs_top10")
def recs_top10(spark, sf):
    t = Tables(spark, sf)
    return rc.recommend(t.plain_events(), _segments(t), t.products())


@register("recs_wide")
def recs_wide(spark, sf):
    t = Tables(spark, sf)
    return rc.recommendation_records(rc.recommend(t.plain_events(), _segments(t), t.products()),
                                     RUN_ID, AS_OF)


# --- brands -----------------------------------------------------------------

@register("brand_age_metrics")
def brand_age_metrics(spark, sf):
    t = Tables(spark, sf)
    return br.brand_age_metrics(t.events(), t.users(), AS_OF)


@register("brand_top100")
def brand_top100(spark, sf):
    t = Tables(spark, sf)
    return br.restrict_to_top_brands(br.brand_age_metrics(t.events(), t.users(), AS_OF))


@register("brand_records")
def brand_records(spark, sf):
    t = Tables(spark, sf)
    return br.brand_records(br.brand_age_metrics(t.events(), t.users(), AS_OF), RUN_ID, AS_OF)


@register("brand_top10_revenue")
def brand_top10_revenue(spark, sf):
    t = Tables(spark, sf)
    return br.top_brands_by(br.brand_age_metrics(t.events(), t.users(), AS_OF), "total_revenue", 10,
                            ("brand", "age_group"))


@register("brand_user_metrics")
def brand_user_metrics(spark, sf):
    t = Tables(spark, sf)
    return br.brand_user_metrics(t.events(), _segments(t))


@register("brand_dominant_age")
def brand_dominant_age(spark, sf):
    t = Tables(spark, sf)
    return br.dominant_age_group(t.events(), _segments(t))


@register("brand_top3_records")
def brand_top3_records(spark, sf):
    t = Tables(spark, sf)
    return br.brand_top_records(br.brand_user_metrics(t.events(), _segments(t)), RUN_ID, AS_OF)


@register("order_brand_age_metrics")
def order_brand_age_metrics(spark, sf):
    """Brand x age metrics over order lines (purchase events at lineitem size)."""
    t = Tables(spark, sf)
    return br.brand_age_metrics(t.order_events(), t.users(), AS_OF)


# --- dimensions -------------------------------------------------------------

@register("user_demographics")
def user_demographics(spark, sf):
    return dims.user_demographics(Tables(spark, sf).users(), AS_OF)


@register("distinct_categories")
def distinct_categories(spark, sf):
    return dims.distinct_categories(Tables(spark, sf).events())


@register("first_per_product")
def first_per_product(spark, sf):
    ev = Tables(spark, sf).events()
    return dims.first_per_key(ev, "product_id", "event_id", ["category_code", "brand", "event_id"])


@register("clean_products")
def clean_products(spark, sf):
    return dims.clean_products(Tables(spark, sf).products())


@register("zip_join")
def zip_join(spark, sf):
    """Distinct event users (by id) side by side with customer profiles (by
    key): the positional zip of the original user preparation."""
    t = Tables(spark, sf)
    ids = t.events().select("user_id").distinct()
    prof = t.users().select(F.col("name"), F.col("city"), F.col("birth_date"),
                            F.col("user_id").alias("profile_key"))
    return dims.zip_frames(ids, ["user_id"], prof, ["profile_key"])


@register("extend_ids")
def extend_ids(spark, sf):
    """Distinct event user ids extended with new consecutive ids up to the
    number of customers."""
    t = Tables(spark, sf)
    ids = t.events().select("user_id").distinct()
    return dims.extend_ids(spark, ids, t.raw("customer"))


# --- profiles ---------------------------------------------------------------

@register("event_type_distribution")
def event_type_distribution(spark, sf):
    return pf.event_type_distribution(Tables(spark, sf).plain_events())


@register("events_per_day")
def events_per_day(spark, sf):
    return pf.events_per_day(Tables(spark, sf).plain_events())


@register("events_per_hour")
def events_per_hour(spark, sf):
    return pf.events_per_hour(Tables(spark, sf).plain_events())


@register("distinct_counts")
def distinct_counts(spark, sf):
    t = Tables(spark, sf)
    return pf.distinct_counts(t.plain_events(), t.products())


@register("events_lookback")
def events_lookback(spark, sf):
    return pf.lookback_distribution(Tables(spark, sf).plain_events(), LOOKBACK_AS_OF, hours=24)


@register("recent_purchases")
def recent_purchases(spark, sf):
    return pf.recent_purchases(Tables(spark, sf).plain_events(), LOOKBACK_AS_OF, hours=24)


# --- sliding windows (batch form) -------------------------------------------

@register("sliding_active_users")
def sliding_active_users(spark, sf):
    return sl.active_users(Tables(spark, sf).plain_events())


@register("sliding_active_users_approx")
def sliding_active_users_approx(spark, sf):
    """Exact users of each window, and whether the estimate from stored sketches is in bound
    (the estimate itself differs between sketch libraries)."""
    return sl.active_users_approx(Tables(spark, sf).plain_events()).drop("estimate")


@register("sliding_product_views")
def sliding_product_views(spark, sf):
    return sl.product_views(Tables(spark, sf).events())


@register("sliding_top_products")
def sliding_top_products(spark, sf):
    return sl.top_products(Tables(spark, sf).events())


@register("sliding_purchases")
def sliding_purchases(spark, sf):
    return sl.purchases(Tables(spark, sf).plain_events())


@register("sliding_event_distribution")
def sliding_event_distribution(spark, sf):
    return sl.event_distribution(Tables(spark, sf).plain_events())


@register("sliding_brand_activity")
def sliding_brand_activity(spark, sf):
    return sl.brand_activity(Tables(spark, sf).events())


@register("sliding_top_brands")
def sliding_top_brands(spark, sf):
    return sl.top_brands(Tables(spark, sf).events())


# --- reports over the metric tables -----------------------------------------

from clickflow.plans import reports as rp  # noqa: E402


@register("active_user_summary")
def active_user_summary(spark, sf):
    return rp.active_user_summary(sl.active_users(Tables(spark, sf).plain_events()))


@register("active_user_boxplot")
def active_user_boxplot(spark, sf):
    return rp.active_user_boxplot(sl.active_users(Tables(spark, sf).plain_events()))


@register("active_user_histogram")
def active_user_histogram(spark, sf):
    return rp.active_user_histogram(spark, sl.active_users(Tables(spark, sf).plain_events()))


@register("brand_totals_top3")
def brand_totals_top3(spark, sf):
    return rp.brand_totals_top3(Tables(spark, sf).events())


@register("stage_conversion")
def stage_conversion(spark, sf):
    return rp.stage_conversion(sl.event_distribution(Tables(spark, sf).plain_events()))


@register("purchase_totals")
def purchase_totals(spark, sf):
    return rp.purchase_totals(sl.purchases(Tables(spark, sf).plain_events()))


@register("purchase_series")
def purchase_series(spark, sf):
    return rp.report_windows(sl.purchases(Tables(spark, sf).plain_events()))


@register("top_products_latest")
def top_products_latest(spark, sf):
    return rp.top_products_latest(Tables(spark, sf).events())


@register("latest_snapshot")
def latest_snapshot(spark, sf):
    return rp.brand_snapshots(Tables(spark, sf).events())


def _funnel_records(spark, sf):
    return fn.funnel_records(Tables(spark, sf).events(), RUN_ID, AS_OF)


@register("brand_funnel_top15")
def brand_funnel_top15(spark, sf):
    return rp.brand_funnel_top(_funnel_records(spark, sf))


@register("funnel_totals")
def funnel_totals(spark, sf):
    return rp.funnel_totals(_funnel_records(spark, sf))


@register("view_to_cart_time")
def view_to_cart_time(spark, sf):
    return rp.view_to_cart_time(_funnel_records(spark, sf))


@register("high_conversion_brands")
def high_conversion_brands(spark, sf):
    return rp.high_conversion_brands(_funnel_records(spark, sf))


@register("rate_distribution")
def rate_distribution(spark, sf):
    return rp.rate_distribution(_funnel_records(spark, sf))


def _recs_wide(spark, sf):
    t = Tables(spark, sf)
    return rc.recommendation_records(rc.recommend(t.plain_events(), _segments(t), t.products()), RUN_ID, AS_OF)


@register("most_recommended")
def most_recommended(spark, sf):
    return rp.most_recommended(_recs_wide(spark, sf))


@register("rank_position_totals")
def rank_position_totals(spark, sf):
    return rp.rank_position_totals(_recs_wide(spark, sf))


@register("rank_decay")
def rank_decay(spark, sf):
    return rp.rank_decay(_recs_wide(spark, sf))


@register("age_group_top3")
def age_group_top3(spark, sf):
    return rp.age_group_top3(_recs_wide(spark, sf))


@register("rank_ctr")
def rank_ctr(spark, sf):
    return rp.rank_ctr(_recs_wide(spark, sf))


def _brand_records(spark, sf):
    t = Tables(spark, sf)
    return br.brand_records(br.brand_age_metrics(t.events(), t.users(), AS_OF), RUN_ID, AS_OF, n=None)


@register("brand_rollup")
def brand_rollup(spark, sf):
    return rp.brand_rollup(_brand_records(spark, sf))


@register("brand_top10_by")
def brand_top10_by(spark, sf):
    return rp.brand_top10_by(_brand_records(spark, sf))


@register("brand_arpu")
def brand_arpu(spark, sf):
    return rp.brand_arpu(_brand_records(spark, sf))


@register("brand_grand_totals")
def brand_grand_totals(spark, sf):
    return rp.brand_grand_totals(_brand_records(spark, sf))


@register("high_traffic_brands")
def high_traffic_brands(spark, sf):
    return rp.high_traffic_brands(_brand_records(spark, sf))


@register("window_summary")
def window_summary(spark, sf):
    return rp.window_summaries(Tables(spark, sf).events())


# --- live metrics through Structured Streaming, archive ---------------------
# The driver events are replayed as broker-style messages (value, timestamp)
# from files below the session's checkpoint folder; the stream runs with an
# availableNow trigger and writes the version log; each query replays the
# tables as they are now.

from clickflow.plans.serving import VersionLog, metric_from_key, row_key  # noqa: E402
from clickflow.session import scratch_path  # noqa: E402
from clickflow.sources import archive as ar  # noqa: E402
from clickflow.sources import streams as st  # noqa: E402
from clickflow.streaming import metrics as live  # noqa: E402

def _messages(spark, sf):
    path = scratch_path(spark, "messages")
    st.to_messages(Tables(spark, sf).events()).write.mode("overwrite").parquet(path)
    return path


def _replay(spark, sf, *metrics: str) -> VersionLog:
    root = scratch_path(spark, "replay")
    stream = st.event_stream(spark, fmt="parquet", path=_messages(spark, sf))
    store = VersionLog(spark, f"{root}/store")
    live.run_available(spark, stream, store, f"{root}/checkpoints", metrics, run_id="replay", topk=None,
                       state_partitions=spark.sparkContext.defaultParallelism)
    return store


def _archive(spark, sf) -> str:
    return _archived(spark, spark.read.parquet(_messages(spark, sf)))


#: Every 50th message reaches the broker a day and two hours late, every other 50th a day early.
LATE, EARLY = dt.timedelta(hours=26), dt.timedelta(hours=-24)


def _skewed_archive(spark, sf) -> str:
    """The archive of messages whose broker time is not their event time."""
    path = scratch_path(spark, "messages")
    ev = Tables(spark, sf).events()
    shift = lambda d: F.col("event_time") + F.expr(f"INTERVAL {int(d.total_seconds() // 3600)} HOURS")
    broker = (F.when(F.col("event_id") % 50 == 0, shift(LATE)).when(F.col("event_id") % 50 == 1, shift(EARLY))
              .otherwise(F.col("event_time")))
    st.to_messages(ev.withColumn("broker_time", broker), "broker_time").write.parquet(path)
    return _archived(spark, spark.read.parquet(path))


def _archived(spark, msgs: DataFrame) -> str:
    path = scratch_path(spark, "archive")
    # two scalars (epoch ms of the first and last message) bound the hours
    b = msgs.agg(F.min(F.unix_millis("timestamp")).alias("lo"),
                 F.max(F.unix_millis("timestamp")).alias("hi")).first()
    hour_ms = 3600 * 1000
    start = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=b["lo"] // hour_ms * hour_ms)
    end = dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=(b["hi"] // hour_ms + 1) * hour_ms)
    ar.archive_hours(msgs, start, end, path)
    return path


@register("stream_event_distribution")
def stream_event_distribution(spark, sf):
    return _replay(spark, sf, "event").latest("event").select(
        "window_start", "window_end", "event_type", "event_count")


#: Relative standard deviation of the live estimates, and how many of them are allowed.
LIVE_RSD, LIVE_DEVIATIONS = 0.05, 5


def _live_bound(exact, estimate):
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * (LIVE_RSD * LIVE_DEVIATIONS))


@register("stream_active_users")
def stream_active_users(spark, sf):
    """Live events per window, the exact users of the batch form, and whether the live estimate
    of users lies within its error bound."""
    got = _replay(spark, sf, "active_users").latest("active_users").withColumnRenamed("active_users", "estimate")
    exact = sl.active_users(Tables(spark, sf).plain_events()).select("window_start", "active_users")
    return got.join(exact, "window_start", "full_outer").select(
        "window_start", "window_end", "active_users", "total_events",
        _live_bound(F.col("active_users"), F.col("estimate")).alias("estimate_in_bound"))


@register("stream_purchases")
def stream_purchases(spark, sf):
    """Live purchases per window, with exact buyers and the bound check of the live estimate."""
    got = _replay(spark, sf, "purchases").latest("purchases").withColumnRenamed("purchasing_users", "estimate")
    exact = sl.purchases(Tables(spark, sf).plain_events()).select("window_start", "purchasing_users")
    return got.join(exact, "window_start", "full_outer").select(
        "window_start", "window_end", "purchase_count", F.round("total_revenue", 2).alias("total_revenue"),
        F.round("avg_basket_value", 6).alias("avg_basket_value"), "purchasing_users",
        _live_bound(F.col("purchasing_users"), F.col("estimate")).alias("estimate_in_bound"))


@register("stream_top_products")
def stream_top_products(spark, sf):
    """Per-window top 10 recomputed on the latest view of the live store."""
    v = _replay(spark, sf, "top_view").latest("top_view").select(
        "window_start", "window_end", "product_id", "brand", "category_code", "view_count",
        F.round("avg_price", 6).alias("avg_price"))     # prices travel as DOUBLE in the messages
    return sl.per_window_topk(v, "view_count", ["product_id", "brand", "category_code"])


@register("stream_brand_activity")
def stream_brand_activity(spark, sf):
    return _replay(spark, sf, "brand").latest("brand").select(
        "window_start", "window_end", "brand", "event_type", "event_count",
        F.round("total_value", 2).alias("total_value"))


@register("archive_partition_rows")
def archive_partition_rows(spark, sf):
    return ar.verify_archive(spark, _archive(spark, sf)).select("year", "month", "day", "hour", "rows")


@register("archive_verification")
def archive_verification(spark, sf):
    return ar.verify_archive(spark, _archive(spark, sf))


@register("archive_lookback")
def archive_lookback(spark, sf):
    """Event-type distribution of the last 24 h read back from the archive
    (partition-pruned, half-open)."""
    rows = ar.read_window(spark, _archive(spark, sf), LOOKBACK_AS_OF - dt.timedelta(hours=24),
                          LOOKBACK_AS_OF)
    return pf.event_type_distribution(rows)


# --- job displays: top 10 of the funnel ---------------------------------------

@register("funnel_top10_categories")
def funnel_top10_categories(spark, sf):
    f = fn.funnel_by_category(Tables(spark, sf).events())
    return f.orderBy(F.col("users_viewed").desc(), F.col("category_code").asc_nulls_last()).limit(10)


@register("funnel_top10_brands")
def funnel_top10_brands(spark, sf):
    f = fn.funnel_by_brand(Tables(spark, sf).events())
    return f.orderBy(F.col("users_viewed").desc(), F.col("brand").asc_nulls_last()).limit(10)


@register("segment_ranked_list")
def segment_ranked_list(spark, sf):
    """Each segment's recommendation list in rank order (the per-segment
    top 10 the serving writer reads), as one ordered result."""
    t = Tables(spark, sf)
    return rc.recommend(t.plain_events(), _segments(t), t.products()).orderBy("age_group", "rank")


# --- raw log path, replay remap, keyed messages --------------------------------

from clickflow.functions import clean as cl  # noqa: E402
from clickflow.functions.timefns import remap_replay_time  # noqa: E402
from clickflow.sources import files as fl  # noqa: E402

RAW_LOG_MONTH = "2024-01"


def _raw_log(spark, sf):
    """The commerce events written as the raw monthly CSV log (all strings,
    ``yyyy-MM-dd HH:mm:ss UTC`` times, empty strings for missing values)."""
    path = scratch_path(spark, "rawlog")
    ev = Tables(spark, sf).events()
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    raw = ev.select(
        F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        "event_type", s("product_id").alias("product_id"), s("category_code").alias("category_id"),
        s("category_code").alias("category_code"), s("brand").alias("brand"),
        s("price").alias("price"), s("user_id").alias("user_id"),
        F.lit("").alias("user_session"))
    raw.write.mode("overwrite").option("header", "true").csv(path)
    return fl.read_raw_log(spark, path)


@register("raw_log_day_counts")
def raw_log_day_counts(spark, sf):
    """Events per day of month of one month's raw CSV log (string prefix
    filter + day characters, as the log counter does), after cleaning."""
    raw = _raw_log(spark, sf).filter(F.col("event_time").startswith(RAW_LOG_MONTH))
    ev = cl.clean_events(raw)
    return (ev.groupBy(cl.day_of_log(F.col("event_time")).alias("day"))
              .agg(F.count(F.lit(1)).alias("event_count"),
                   F.count("event_timestamp").alias("parsed"),
                   F.count("brand").alias("with_brand")))


@register("remap_time")
def remap_time(spark, sf):
    """Replay remap of the log (days >= 27 stay in December of the target
    year, earlier days move to January of the next): events per mapped day."""
    ev = Tables(spark, sf).plain_events()
    m = remap_replay_time(F.col("event_time"), 2024)
    return ev.groupBy(F.to_date(m).alias("mapped_day")).agg(
        F.count(F.lit(1)).alias("event_count"), F.min(m).alias("first_mapped"))


@register("event_messages")
def event_messages(spark, sf):
    """Keyed JSON messages of the commerce events (key = user id)."""
    return st.to_messages(Tables(spark, sf).events())


# --- event-time look-backs on the archive ---------------------------------------

def _archived_events(spark, sf, start, end=None) -> DataFrame:
    rows = ar.read_event_time(spark, _skewed_archive(spark, sf), start, end)
    return rows.select(F.col("event_timestamp").alias("event_time"), "user_id", "event_type", "product_id",
                       "category_code", "brand", F.col("price").cast("decimal(18,2)").alias("price"))


@register("archive_zone_map")
def archive_zone_map(spark, sf):
    """Rows and event-time bounds of every archive hour, from its zone map."""
    return ar.hour_zones(spark, _skewed_archive(spark, sf)).filter(~F.col("open")).select(
        "year", "month", "day", "hour", "rows", "low", "high")


@register("archive_funnel_24h")
def archive_funnel_24h(spark, sf):
    """Brand funnel of the archive's closed 24 h look-back by event time, early and late messages included."""
    return fn.funnel_by_brand(_archived_events(spark, sf, LOOKBACK_AS_OF - dt.timedelta(hours=24), LOOKBACK_AS_OF))


@register("archive_brand_7d")
def archive_brand_7d(spark, sf):
    """Brand x age metrics of the archive's last seven days by event time, early and late messages included."""
    ev = _archived_events(spark, sf, LOOKBACK_AS_OF - dt.timedelta(days=7))
    return br.brand_age_metrics(ev, Tables(spark, sf).users(), AS_OF)


# --- log slice, archive tables and partitions -----------------------------------

PROFILE_DAY = dt.datetime(2024, 1, 15)


def _table_name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:12]}"


def _and_drop(spark, name: str, result: DataFrame) -> DataFrame:
    """``result`` of the external table ``name``, computed, and the table's entry dropped (its files stay)."""
    out = materialize(result)
    spark.sql(f"DROP TABLE {name}")
    return out


@register("log_slice_types")
def log_slice_types(spark, sf):
    """Event types of one day's half-open slice of the message log."""
    start = int(PROFILE_DAY.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    rows = st.log_slice(spark, start, start + 24 * 3600 * 1000, fmt="parquet", path=_messages(spark, sf))
    return pf.event_type_distribution(st.decode(rows))


@register("archive_columns")
def archive_columns(spark, sf):
    """Two columns of the archived event table."""
    ev = fl.read_events(spark, _archive(spark, sf), ["event_type", "brand"])
    return ev.groupBy("event_type", "brand").agg(F.count(F.lit(1)).alias("event_count"))


@register("archive_day_purchases")
def archive_day_purchases(spark, sf):
    """Purchases per hour of one archived day (partition-pruned)."""
    day = fl.read_partition(spark, _archive(spark, sf), PROFILE_DAY.year, PROFILE_DAY.month, PROFILE_DAY.day,
                            "purchase")
    return day.groupBy("hour").agg(F.count(F.lit(1)).alias("purchases"),
                                   F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("revenue"))


@register("event_table_days")
def event_table_days(spark, sf):
    """Rows per day and event type of the external table over the archive, partitions discovered."""
    name = _table_name("events")
    fl.create_events_table(spark, name, _archive(spark, sf))
    return _and_drop(spark, name, spark.table(name).groupBy("year", "month", "day", "event_type").agg(
        F.count(F.lit(1)).alias("event_count")))


@register("event_table_partitions")
def event_table_partitions(spark, sf):
    """The discovered partitions of the external table."""
    name = _table_name("events")
    fl.create_events_table(spark, name, _archive(spark, sf))
    part = lambda c: F.regexp_extract("partition", f"{c}=(\\d+)", 1).cast("int").alias(c)
    return _and_drop(spark, name, fl.show_partitions(spark, name).select(
        *[part(c) for c in ("year", "month", "day", "hour")]))


@register("event_table_added_hour")
def event_table_added_hour(spark, sf):
    """Event types of one hour, added to the external table by hand."""
    path, name = _archive(spark, sf), _table_name("events")
    fl.create_events_table(spark, name, path, discover=False)
    fl.add_partition(spark, name, PROFILE_DAY.year, PROFILE_DAY.month, PROFILE_DAY.day, 12,
                     f"{path}/{PROFILE_DAY:year=%Y/month=%m/day=%d}/hour=12")
    return _and_drop(spark, name, pf.event_type_distribution(spark.table(name)))


# --- sinks read back ---------------------------------------------------------------

@register("users_csv_readback")
def users_csv_readback(spark, sf):
    """User profiles written as CSV and read by header name, whatever the order of the columns."""
    path = scratch_path(spark, "users-csv")
    u = Tables(spark, sf).users()
    none = F.lit(None).cast("string")
    dims.write_csv(u.select("city", "birth_date", "name", none.alias("surname"),
                            F.lpad((F.col("user_id") % 100000).cast("string"), 5, "0").alias("zip_code"),
                            none.alias("street_name"), none.alias("house_number"), "user_id"), path)
    return fl.read_users(spark, path).select("user_id", "name", "birth_date", "city", "zip_code")


@register("users_parquet_readback")
def users_parquet_readback(spark, sf):
    path = scratch_path(spark, "users")
    dims.write_parquet(Tables(spark, sf).users(), path)
    return spark.read.parquet(path)


@register("products_readback")
def products_readback(spark, sf):
    """The cleaned catalogue, partitioned by category, read back."""
    path = scratch_path(spark, "products")
    dims.write_products(dims.clean_products(Tables(spark, sf).products()), path)
    return spark.read.parquet(path)


@register("product_csv_table")
def product_csv_table(spark, sf):
    """Products per brand of a delimited external table."""
    path, name = scratch_path(spark, "products-csv"), _table_name("products")
    dims.write_csv(Tables(spark, sf).products().select("product_id", "product_name", "brand"), path)
    fl.create_csv_table(spark, name, path, "product_id BIGINT, product_name STRING, brand STRING")
    return _and_drop(spark, name, spark.table(name).groupBy("brand").agg(
        F.count(F.lit(1)).alias("products"), F.max("product_id").alias("last_product_id")))


@register("serving_prefix_scan")
def serving_prefix_scan(spark, sf):
    """One day of the event mix, by key prefix from the serving store."""
    store = VersionLog(spark, scratch_path(spark, "prefix"))
    rows = sl.event_distribution(Tables(spark, sf).plain_events()).withColumn("row_key", row_key("event"))
    store.write(rows, "event", RUN_ID, 0, created_at=ntz_lit(AS_OF))
    return store.scan("event", f"{PROFILE_DAY:%Y%m%d}_").select(
        "row_key", "window_start", "window_end", "event_type", "event_count")


@register("window_key_events")
def window_key_events(spark, sf):
    """Every window key of the month with its number of events."""
    keys = window_keys(spark, "20240101_0000", "20240131_2355")
    au = sl.active_users(Tables(spark, sf).plain_events()).select("window_start", "total_events")
    return keys.join(au, "window_start", "left").select(
        "window_key", F.coalesce("total_events", F.lit(0).cast("bigint")).alias("total_events"))


# --- normalisation, naming, lists ------------------------------------------------------

@register("normalised_events")
def normalised_events(spark, sf):
    """The raw CSV log's rows, typed."""
    return cl.clean_events(_raw_log(spark, sf)).select(
        "event_timestamp", "event_type", "product_id", "category_code", "brand", "price", "user_id")


@register("coerced_numbers")
def coerced_numbers(spark, sf):
    """Text columns of the raw log coerced to numbers: NULL or a default where that fails."""
    return _raw_log(spark, sf).groupBy("event_type").agg(
        F.sum(cl.coerce_numeric(F.col("product_id"), None)).alias("product_ids"),
        F.count(cl.coerce_numeric(F.col("brand"), None)).alias("numeric_brands"),
        F.sum(cl.coerce_numeric(F.col("brand"), 1.0)).alias("defaults"))


@register("named_products")
def named_products(spark, sf):
    """Products with category and product names joined by key."""
    p = Tables(spark, sf).products()
    return dims.name_products(p.select("product_id", "category_id", "brand"),
                              p.select("category_id", "category_name").distinct(),
                              p.select("product_id", "product_name"))


@register("recommended_items")
def recommended_items(spark, sf):
    """Distinct items of all recommendation lists."""
    t = Tables(spark, sf)
    recs = rc.recommend(t.plain_events(), _segments(t), t.products())
    return recs.select("product_id", "product_name").distinct()


@register("views_top10")
def views_top10(spark, sf):
    """The ten largest view counts over all windows, as one micro-batch lists them."""
    return sl.micro_batch_topk(sl.product_views(Tables(spark, sf).events()), "view_count",
                               ["window_start", "product_id", "brand", "category_code"])


@register("first_events")
def first_events(spark, sf):
    """The first ten events (a plain limit, made deterministic by the event id)."""
    return Tables(spark, sf).plain_events().orderBy("event_id").limit(10)


@register("order_daily_top_products")
def order_daily_top_products(spark, sf):
    """Ten products with the most order lines of each day."""
    ev = Tables(spark, sf).plain_order_events()
    n = ev.groupBy(F.to_date("event_time").alias("window_start"), "product_id").agg(
        F.count(F.lit(1)).alias("lines"))
    return sl.per_window_topk(n, "lines", ["product_id"]).withColumnRenamed("window_start", "day")


@register("order_daily_top_brands")
def order_daily_top_brands(spark, sf):
    """Ten brands with the largest revenue of each day; brands are joined after the sum by product."""
    t = Tables(spark, sf)
    by_product = t.plain_order_events().groupBy(F.to_date("event_time").alias("window_start"), "product_id").agg(
        F.sum("price").alias("revenue"))
    by_brand = by_product.join(t.products().select("product_id", "brand"), "product_id").groupBy(
        "window_start", "brand").agg(F.sum("revenue").cast("double").alias("revenue"))
    return sl.per_window_topk(by_brand, "revenue", ["brand"]).withColumnRenamed("window_start", "day")


@register("order_brand_top5")
def order_brand_top5(spark, sf):
    """Brand x age metrics over order lines, of the five brands with the largest revenue."""
    t = Tables(spark, sf)
    return br.restrict_to_top_brands(br.brand_age_metrics(t.order_events(), t.users(), AS_OF), 5)


# --- live runs that are cut, late, failing or several -----------------------------

MID_LOG = dt.datetime(2024, 1, 15, 12, 0, 30)
LATE_DAYS, LIST_DAYS = 5, 10


def _live(spark, name: str):
    root = scratch_path(spark, name)
    return f"{root}/messages", f"{root}/checkpoints", VersionLog(spark, f"{root}/store"), f"{root}/fallback"


def _day_chunk(days: int):
    """Number of the run of ``days`` days of January that the event lies in."""
    return F.floor((F.dayofmonth("event_time") - 1) / days).cast("int")


def _admitted(spark, ev: DataFrame, batch, path: str) -> DataFrame:
    """A stream that admits one batch of ``ev`` per trigger, in the order of ``batch``."""
    n = st.write_batches(ev, batch, path, spark.sparkContext.defaultParallelism)
    return st.event_stream(spark, fmt="parquet", path=path, options={"maxFilesPerTrigger": str(n)})


def _run(spark, stream, store, checkpoints, *metrics, **options) -> live.StreamWatch:
    return live.run_available(spark, stream, store, checkpoints, metrics,
                              **{"run_id": "replay", "topk": None, **options},
                              state_partitions=spark.sparkContext.defaultParallelism)


@register("stream_restarted")
def stream_restarted(spark, sf):
    """Event mix of a query that was stopped after half of the log and started again on its
    checkpoint: windows that lie across the stop keep what they had."""
    path, checkpoints, store, _ = _live(spark, "restarted")
    ev = Tables(spark, sf).events()
    for half in (F.col("event_time") < ntz_lit(MID_LOG), F.col("event_time") >= ntz_lit(MID_LOG)):
        st.to_messages(ev.filter(half)).write.mode("append").parquet(path)
        queries = live.start_metrics(st.event_stream(spark, fmt="parquet", path=path), store, checkpoints, ("event",),
                                     run_id="restarted", topk=None,
                                     state_partitions=spark.sparkContext.defaultParallelism)
        live.stop_metrics(queries)      # drains what is there, then stops
    return store.latest("event").select("window_start", "window_end", "event_type", "event_count")


@register("stream_late_events")
def stream_late_events(spark, sf):
    """Event mix where every tenth message comes two triggers (ten days) late: windows as the
    watermark keeps them, and, without a window, the number of groups of a trigger that it
    dropped. Spark tells late rows by the watermark that the trigger before started with."""
    path, checkpoints, store, _ = _live(spark, "late")
    late = F.when(F.col("event_id") % 10 == 3, 2).otherwise(0)
    stream = _admitted(spark, Tables(spark, sf).events(), _day_chunk(LATE_DAYS) + late, path)
    watch = _run(spark, stream, store, checkpoints, "event")
    dropped = sum(watch.dropped.values())
    kept = store.latest("event").select("window_start", "window_end", "event_type", "event_count")
    none = F.lit(None).cast("timestamp_ntz")
    return kept.unionByName(spark.range(1).select(
        none.alias("window_start"), none.alias("window_end"), F.lit("dropped").alias("event_type"),
        F.lit(dropped).cast("bigint").alias("event_count")))


class _FailingLog(VersionLog):
    """A store whose writes of one epoch fail (an outage, for the fallback's query)."""

    def __init__(self, spark, root, epoch):
        super().__init__(spark, root)
        self.epoch = epoch

    def write(self, rows, metric, run_id, epoch_id, created_at=None):
        if epoch_id == self.epoch:
            raise OSError("the store is not available")
        super().write(rows, metric, run_id, epoch_id, created_at)


@register("stream_reconciled")
def stream_reconciled(spark, sf):
    """Event mix of a run during which the store failed for one epoch: its batch went to the
    fallback folder and was brought in afterwards."""
    path, checkpoints, store, fallback = _live(spark, "reconciled")
    stream = _admitted(spark, Tables(spark, sf).events(), _day_chunk(LIST_DAYS), path)
    _run(spark, stream, _FailingLog(spark, store.root, 1), checkpoints, "event", fallback=fallback)
    live.reconcile_fallback(store, "event", "replay", fallback)
    return store.latest("event").select("window_start", "window_end", "event_type", "event_count")


@register("stream_top10")
def stream_top10(spark, sf):
    """The live top ten of viewed products after the last trigger: rows that left the list are gone."""
    path, checkpoints, store, _ = _live(spark, "top10")
    stream = _admitted(spark, Tables(spark, sf).events(), _day_chunk(LIST_DAYS), path)
    _run(spark, stream, store, checkpoints, "top_view", topk="micro_batch")
    return store.latest("top_view").select("rank", "window_start", "product_id", "brand", "category_code", "view_count")


@register("stream_two_metrics")
def stream_two_metrics(spark, sf):
    """Two live queries under one wait: events, and events with a brand, of each window."""
    store = _replay(spark, sf, "event", "brand")
    ev = store.latest("event").groupBy("window_start").agg(F.sum("event_count").alias("events"))
    br_ = store.latest("brand").groupBy("window_start").agg(F.sum("event_count").alias("branded_events"))
    return ev.join(br_, "window_start", "left")


# --- profiles, regions, key kinds, mixed CSV --------------------------------------

def _raw_profiles(users: DataFrame) -> DataFrame:
    """Users under the column names of the raw profile file."""
    return users.select(F.col("name").alias("Name"), F.upper("name").alias("Surname"),
                        F.col("birth_date").cast("string").alias("Birth Date"), F.col("city").alias("City"),
                        F.col("user_id").cast("string").alias("Postal Code"),
                        F.lit("Street").alias("Street Name"), F.lit("1").alias("House Number"))


@register("renamed_profiles")
def renamed_profiles(spark, sf):
    """The raw profile file, written as CSV, read and given its snake_case names."""
    path = scratch_path(spark, "profiles")
    dims.write_csv(_raw_profiles(Tables(spark, sf).users()), path)
    return dims.rename_profile_columns(spark.read.option("header", "true").csv(path))


@register("segment_regions")
def segment_regions(spark, sf):
    """Users per constant region and age group."""
    return _segments(Tables(spark, sf)).groupBy("region", "age_group").agg(F.count(F.lit(1)).alias("users"))


@register("row_key_kinds")
def row_key_kinds(spark, sf):
    """Rows of all five live metrics by the kind that their key tells."""
    ev = Tables(spark, sf).events()
    frames = {"active_users": sl.active_users(ev), "purchases": sl.purchases(ev), "event": sl.event_distribution(ev),
              "top_view": sl.product_views(ev), "brand": sl.brand_activity(ev)}
    keys = None
    for metric, df in frames.items():
        k = df.select(row_key(metric).alias("row_key"))
        keys = k if keys is None else keys.unionByName(k)
    return keys.groupBy(metric_from_key(F.col("row_key")).alias("kind")).agg(F.count(F.lit(1)).alias("keys"))


@register("users_csv_mixed")
def users_csv_mixed(spark, sf):
    """User profiles from a folder of CSV files with two orders of columns."""
    path = scratch_path(spark, "users-mixed")
    u = Tables(spark, sf).users()
    none = [F.lit(None).cast("string").alias(c) for c in ("surname", "zip_code", "street_name", "house_number")]
    even = u.filter(F.col("user_id") % 2 == 0).select("user_id", "name", "birth_date", "city", *none)
    odd = u.filter(F.col("user_id") % 2 == 1).select("city", *none, "birth_date", "name", "user_id")
    for part in (even, odd):
        part.write.mode("append").option("header", "true").csv(path)
    return fl.read_csv_mixed(spark, path, fl.USERS).select("user_id", "name", "birth_date", "city")
