"""Open, unordered view -> cart -> purchase funnel.

A user counts at "cart" without a prior view, so rates can exceed 1,
drop-offs can be negative and stage durations can be negative.

Plan shape (one shuffle per level, each with map-side partial aggregation,
so a hot user, product or category is combined before it moves):

1. ``first_touch``: group by (user, product, category, brand); first time of
   each stage, 0/1 stage flags, stage durations.
2. ``funnel``: group by (key, user) -> per-user stage flags and duration
   sums/counts; then group by key -> distinct users per stage (a count, since
   rows are now unique per user), mean durations, guarded rates.

This replaces the three ``count(DISTINCT ...)`` of the direct form, which
Spark plans as an Expand tripling the rows before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.clean import label_or_unknown
from clickflow.functions.ratios import guarded_dropoff, guarded_ratio, safe_float, safe_int
from clickflow.functions.timefns import ntz_lit

# Funnel stages in order.
STAGES = ("view", "cart", "purchase")
TOUCH_KEYS = ("user_id", "product_id", "category_code", "brand")
DURATIONS = (("view_to_cart_seconds", "view", "cart"),
             ("cart_to_purchase_seconds", "cart", "purchase"),
             ("view_to_purchase_seconds", "view", "purchase"))
FUNNEL_METRICS = ("users_viewed", "users_added_to_cart", "users_purchased",
                  "avg_view_to_cart_seconds", "avg_cart_to_purchase_seconds",
                  "avg_view_to_purchase_seconds", "view_to_cart_rate",
                  "cart_to_purchase_rate", "view_to_purchase_rate",
                  "view_to_cart_dropoff", "cart_to_purchase_dropoff")


def first_touch(events: DataFrame, ts: str = "event_time") -> DataFrame:
    """Per (user, product, category, brand): ``<stage>_time`` (first touch),
    ``has_<stage>`` (0/1) and the three stage durations in whole seconds
    (NULL unless both ends exist)."""
    et = F.col("event_type")
    aggs = []
    for s in STAGES:
        aggs.append(F.min(F.when(et == s, F.col(ts))).alias(f"{s}_time"))
    for s in STAGES:
        aggs.append(F.max(F.when(et == s, F.lit(1)).otherwise(F.lit(0))).alias(f"has_{s}"))
    touch = events.groupBy(*TOUCH_KEYS).agg(*aggs)
    cols = [F.col(c) for c in touch.columns]
    for name, a, b in DURATIONS:
        ta, tb = F.col(f"{a}_time"), F.col(f"{b}_time")
        cols.append(F.when(ta.isNotNull() & tb.isNotNull(),
                           F.unix_timestamp(tb) - F.unix_timestamp(ta)).alias(name))
    return touch.select(*cols)


def funnel(touch: DataFrame, key) -> DataFrame:
    """Funnel measures per ``key`` (a column name or a list of them;
    ``category_code`` keeps its NULL group; callers drop NULL brands, as the
    brand funnel does)."""
    keys = [key] if isinstance(key, str) else list(key)
    per_user = touch.groupBy(*keys, "user_id").agg(
        *[F.max(f"has_{s}").alias(f"u_{s}") for s in STAGES],
        *[F.sum(n).alias(f"sum_{n}") for n, _, _ in DURATIONS],
        *[F.count(n).alias(f"cnt_{n}") for n, _, _ in DURATIONS],
    )
    uid = F.col("user_id")
    agg = per_user.groupBy(*keys).agg(
        F.count(F.when(F.col("u_view") > 0, uid)).alias("users_viewed"),
        F.count(F.when(F.col("u_cart") > 0, uid)).alias("users_added_to_cart"),
        F.count(F.when(F.col("u_purchase") > 0, uid)).alias("users_purchased"),
        *[F.try_divide(F.sum(f"sum_{n}").cast("double"), F.sum(f"cnt_{n}")).alias(f"avg_{n}")
          for n, _, _ in DURATIONS],
    )
    v, c, p = F.col("users_viewed"), F.col("users_added_to_cart"), F.col("users_purchased")
    return agg.select(
        *keys, "users_viewed", "users_added_to_cart", "users_purchased",
        "avg_view_to_cart_seconds", "avg_cart_to_purchase_seconds", "avg_view_to_purchase_seconds",
        guarded_ratio(c, v).alias("view_to_cart_rate"),
        guarded_ratio(p, c).alias("cart_to_purchase_rate"),
        guarded_ratio(p, v).alias("view_to_purchase_rate"),
        guarded_dropoff(c, v).alias("view_to_cart_dropoff"),
        guarded_dropoff(p, c).alias("cart_to_purchase_dropoff"),
    )


def funnel_by_category(events: DataFrame, touch: DataFrame | None = None) -> DataFrame:
    return funnel(touch if touch is not None else first_touch(events), "category_code")


def funnel_by_brand(events: DataFrame, touch: DataFrame | None = None) -> DataFrame:
    t = touch if touch is not None else first_touch(events)
    return funnel(t.filter(F.col("brand").isNotNull()), "brand")


def funnel_records(events: DataFrame, run_id: str, created_at) -> DataFrame:
    """Serving rows of both kinds in one keyed table.

    ``row_key = <run_id>_<type>_<name>``; NULL category becomes ``unknown``;
    rates rounded to 4 places, mean durations truncated to whole seconds,
    missing values 0.

    Each touch row is tagged with both of its keys, (category, value) and
    (brand, value) — rows without a brand drop the brand tag — and one
    funnel aggregation runs over (type, key). The event-level touch shuffle,
    the largest of the plan, therefore runs once for both kinds.
    """
    touch = first_touch(events)
    tags = F.array(
        F.struct(F.lit("category").alias("type"), F.col("category_code").alias("key"),
                 F.lit(True).alias("keep")),
        F.struct(F.lit("brand").alias("type"), F.col("brand").alias("key"),
                 F.col("brand").isNotNull().alias("keep")))
    tagged = touch.select("*", F.inline(tags)).filter(F.col("keep")).drop("keep")
    both = funnel(tagged, ["type", "key"]).withColumn(
        "name", F.when(F.col("type") == "category", label_or_unknown(F.col("key")))
                 .otherwise(F.col("key")))
    out = [F.concat_ws("_", F.lit(run_id), F.col("type"), F.col("name")).alias("row_key"),
           "type", "name", "users_viewed", "users_added_to_cart", "users_purchased"]
    for m in ("view_to_cart_rate", "cart_to_purchase_rate", "view_to_purchase_rate",
              "view_to_cart_dropoff", "cart_to_purchase_dropoff"):
        out.append(safe_float(F.col(m), 4).alias(m))
    for m in ("avg_view_to_cart_seconds", "avg_cart_to_purchase_seconds",
              "avg_view_to_purchase_seconds"):
        out.append(safe_int(F.col(m)).alias(m))
    out.append(ntz_lit(created_at).alias("created_at"))
    return both.select(*out)
