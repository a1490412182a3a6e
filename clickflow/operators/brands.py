"""Brand performance: brand x age metrics, top-N restriction, the user-based
variant with the dominant age group, and their serving records.

Plan shape: events with a brand are reduced to one row per (user, brand)
(counts per stage, revenue) before the users dimension is joined, so the
join and every later shuffle carry at most one row per user-brand pair and a
hot user or brand is combined map-side. Distinct users per (brand, age
group) are then counts of rows; per brand they are sums over age groups
(a user has exactly one age group). The dominant age group comes from the
same (brand, age_group) aggregate as a maximum of numbers, so no window, sort
or extra join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.demographics import BAND_A_REST, BANDS_A, age_band_a, exact_age
from clickflow.functions.ratios import guarded_ratio
from clickflow.operators.recommend import segment_of_user
from clickflow.plans.joins import materialize, one_per_user
from clickflow.functions.timefns import ntz_lit

# List sizes of the two serving writers.
TOP_BRANDS = 100
TOP_RECORD_BRANDS = 3
STAGES = ("view", "cart", "purchase")


def user_brand_activity(events: DataFrame, revenue_default_zero: bool) -> DataFrame:
    """One row per (user_id, brand) for events with a brand."""
    et = F.col("event_type")
    purchase_price = F.when(et == "purchase", F.col("price"))
    if revenue_default_zero:
        purchase_price = purchase_price.otherwise(F.lit(0).cast(events.schema["price"].dataType))
    return (events.filter(F.col("brand").isNotNull())
            .groupBy("user_id", "brand").agg(
                *[F.count(F.when(et == s, F.lit(1))).alias(f"n_{s}") for s in STAGES],
                F.count(F.lit(1)).alias("n_events"),
                F.sum(purchase_price).alias("revenue")))


def brand_age_metrics(events: DataFrame, users: DataFrame, as_of) -> DataFrame:
    """Per (brand, age_group): unique_users, total_views, total_purchases
    (event counts), total_revenue (0 when none), overall_conversion_rate.

    Users are LEFT joined: events of unknown users stay and fall into 55+.
    """
    ages = one_per_user(users, "birth_date").select("user_id", exact_age(F.col("birth_date"), as_of).alias("age"))
    ub = user_brand_activity(events, revenue_default_zero=True)
    j = ub.join(ages, "user_id", "left").withColumn("age_group", age_band_a(F.col("age")))
    m = j.groupBy("brand", "age_group").agg(
        F.count("user_id").alias("unique_users"),
        F.sum("n_view").alias("total_views"),
        F.sum("n_purchase").alias("total_purchases"),
        F.sum("revenue").cast("double").alias("total_revenue"))
    return m.withColumn("overall_conversion_rate",
                        guarded_ratio(F.col("total_purchases"), F.col("total_views")))


def top_brands_by_revenue(metrics: DataFrame, n: int = TOP_BRANDS) -> DataFrame:
    """The n brands with the largest summed revenue (ties: brand asc)."""
    return (metrics.groupBy("brand").agg(F.sum("total_revenue").alias("brand_total_revenue"))
            .orderBy(F.col("brand_total_revenue").desc_nulls_last(), F.col("brand").asc())
            .limit(n))


def restrict_to_top_brands(metrics: DataFrame, n: int = TOP_BRANDS) -> DataFrame:
    """Rows of ``metrics`` whose brand is among the top n by revenue.

    The top list has at most n rows, so broadcasting it is size-bound; the
    semi join equals the inner join on its unique brand column. ``metrics``
    (one row per brand and age group) is read by both the top-N list and the
    filter, so it is materialised once: the events pipeline behind it runs
    a single time.
    """
    metrics = materialize(metrics)
    top = F.broadcast(top_brands_by_revenue(metrics, n).select("brand"))
    return metrics.join(top, "brand", "left_semi")


def brand_records(metrics: DataFrame, run_id: str, created_at, n: int | None = TOP_BRANDS) -> DataFrame:
    """Serving rows ``<run>_<brand>_<age_group>`` of the top-n brands (None: all,
    as the reports read them); revenue 2 places, conversion 4 places."""
    return (metrics.filter(F.col("brand").isNotNull()) if n is None else restrict_to_top_brands(metrics, n)).select(
        F.concat_ws("_", F.lit(run_id), F.col("brand"), F.col("age_group")).alias("row_key"),
        "brand", "age_group", "unique_users", "total_views", "total_purchases",
        F.round("total_revenue", 2).alias("total_revenue"),
        F.round("overall_conversion_rate", 4).alias("conversion_rate"),
        ntz_lit(created_at).alias("created_at"))


def brand_age_event_counts(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Events per (brand, age_group) for known users."""
    ub = user_brand_activity(events, revenue_default_zero=False)
    j = ub.join(segment_of_user(segments), "user_id", "inner")
    return j.groupBy("brand", "age_group").agg(F.sum("n_events").alias("events_count"))


_GROUPS = [label for _, label in BANDS_A] + [BAND_A_REST]


def _vote(count: Column) -> Column:
    """A number that is greatest for the age group with the most events, and among equals
    for the smaller label: count and the group's place from the end, in one whole number
    (a maximum of numbers is a hash aggregate)."""
    place = F.array_position(F.array(*[F.lit(g) for g in _GROUPS]), F.col("age_group"))
    return (count.cast("decimal(20,0)") * 10 + (9 - place)).cast("decimal(23,0)")


def _voted(vote: str) -> tuple[Column, Column]:
    """(age group, its count) of a vote."""
    place = (9 - F.col(vote) % 10).cast("int")
    return (F.element_at(F.array(*[F.lit(g) for g in _GROUPS]), place),
            F.floor(F.col(vote) / 10).cast("bigint"))


def brand_user_metrics(events: DataFrame, segments: DataFrame) -> DataFrame:
    """User-based brand metrics (events INNER users):

    unique_users, viewers, cart_users, buyers (distinct users), total_views,
    total_cart_adds, total_purchases (event counts), total_revenue (NULL when
    no purchase), user-based rates, and ``age_group`` = the age group with the
    most events (ties: smaller label).
    """
    ub = user_brand_activity(events, revenue_default_zero=False)
    j = ub.join(segment_of_user(segments), "user_id", "inner")
    per_age = j.groupBy("brand", "age_group").agg(
        F.count(F.lit(1)).alias("users"),
        *[F.count(F.when(F.col(f"n_{s}") > 0, F.lit(1))).alias(f"users_{s}") for s in STAGES],
        *[F.sum(f"n_{s}").alias(f"n_{s}") for s in STAGES],
        F.sum("n_events").alias("events_count"),
        F.sum("revenue").alias("revenue"))
    m = per_age.groupBy("brand").agg(
        F.sum("users").alias("unique_users"),
        F.sum("users_view").alias("viewers"),
        F.sum("users_cart").alias("cart_users"),
        F.sum("users_purchase").alias("buyers"),
        F.sum("n_view").alias("total_views"),
        F.sum("n_cart").alias("total_cart_adds"),
        F.sum("n_purchase").alias("total_purchases"),
        F.sum("revenue").cast("double").alias("total_revenue"),
        F.max(_vote(F.col("events_count"))).alias("vote"))
    return m.select(
        "brand", "unique_users", "viewers", "cart_users", "buyers", "total_views",
        "total_cart_adds", "total_purchases", "total_revenue",
        guarded_ratio(F.col("cart_users"), F.col("viewers")).alias("view_to_cart_rate"),
        guarded_ratio(F.col("buyers"), F.col("cart_users")).alias("cart_to_purchase_rate"),
        guarded_ratio(F.col("buyers"), F.col("viewers")).alias("overall_conversion_rate"),
        _voted("vote")[0].alias("age_group"))


def dominant_age_group(events: DataFrame, segments: DataFrame) -> DataFrame:
    """brand, age_group with the most events (ties: smaller label), events_count."""
    c = brand_age_event_counts(events, segments)
    best = c.groupBy("brand").agg(F.max(_vote(F.col("events_count"))).alias("vote"))
    group, count = _voted("vote")
    return best.select("brand", group.alias("age_group"), count.alias("events_count"))


def top_brands_by(metrics: DataFrame, col: str, n: int, tie: tuple[str, ...] = ("brand",)) -> DataFrame:
    """Top n rows by ``col`` desc (NULLs last), ties by ``tie`` asc."""
    return metrics.orderBy(F.col(col).desc_nulls_last(), *[F.col(c).asc() for c in tie]).limit(n)


def brand_top_records(metrics: DataFrame, run_id: str, created_at,
                      n: int = TOP_RECORD_BRANDS, period: str = "7days") -> DataFrame:
    """Top-n brands by revenue as serving rows ``<run>_brand_<brand>``."""
    return top_brands_by(metrics, "total_revenue", n).select(
        F.concat(F.lit(f"{run_id}_brand_"), F.col("brand")).alias("row_key"),
        "brand", "unique_users", "total_views", "total_purchases",
        F.round(F.coalesce("total_revenue", F.lit(0.0)), 2).alias("total_revenue"),
        F.round("overall_conversion_rate", 4).alias("conversion_rate"),
        F.coalesce(F.col("age_group"), F.lit("Unknown")).alias("dominant_age_group"),
        ntz_lit(created_at).alias("created_at"),
        F.lit(period).alias("period"), F.lit("active").alias("status"))
