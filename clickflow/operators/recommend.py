"""Top-k product recommendations per demographic segment.

score = distinct viewers + 2 * distinct carting users + 5 * distinct buyers
per (age_group, product); rank by score desc, product_id asc; keep k.

Plan shape: events are first reduced to one row per (user, product) with
0/1 stage flags, event count and purchase revenue (map-side combined, so a
hot user or product collapses before the shuffle). Only that reduced table
is joined to the users dimension (no hint: adaptive execution broadcasts a side
that is small at run time); since a user has one segment, distinct users per
(segment, product) are then plain sums of the flags, with no distinct aggregation.
The top-k runs as a window limited per segment (Spark plans
``row_number() <= k`` as WindowGroupLimit, partial before the shuffle). Names come
from the catalogue by a left join of the tiny ranked list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickflow.functions.clean import UNKNOWN_NAME
from clickflow.functions.demographics import BAND_A_REST, BANDS_A, age_band_a, exact_age
from clickflow.plans.joins import one_per_user
from clickflow.functions.timefns import ntz_lit

# Score weights, list length and the constant region label.
SCORE_WEIGHTS = {"views": 1, "add_to_cart": 2, "purchases": 5}
TOP_K = 10
REGION = "Poland"
STAGE_COLS = (("view", "views"), ("cart", "add_to_cart"), ("purchase", "purchases"))
# Bounded size of the ranked list: k per segment over the fixed bands.
N_SEGMENTS = len(BANDS_A) + 1


def user_segments(users: DataFrame, as_of) -> DataFrame:
    """user_id, city, age, age_group (five bands, unknown age -> 55+),
    region (constant)."""
    age = exact_age(F.col("birth_date"), as_of)
    return users.select("user_id", "city", age.alias("age"),
                        age_band_a(age).alias("age_group"),
                        F.lit(REGION).alias("region"))


def user_product_activity(events: DataFrame) -> DataFrame:
    """One row per (user_id, product_id): has_<stage> flags, n_events,
    purchase revenue (NULL when no purchase)."""
    et = F.col("event_type")
    return events.groupBy("user_id", "product_id").agg(
        *[F.max(F.when(et == s, F.lit(1)).otherwise(F.lit(0))).alias(f"has_{s}") for s, _ in STAGE_COLS],
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.when(et == "purchase", F.col("price"))).alias("revenue"),
    )


def segment_activity_from(joined: DataFrame) -> DataFrame:
    return joined.groupBy("age_group").agg(F.sum("n_events").alias("events_count"))


def segment_of_user(segments: DataFrame) -> DataFrame:
    """user_id, age_group: one row per user, of the least known age (bands ascend with age,
    and an unknown age has the last one). A number's minimum is a hash aggregate; a label's isn't."""
    return one_per_user(segments, "age").select("user_id", age_band_a(F.col("age")).alias("age_group"))


def _joined(events: DataFrame, segments: DataFrame) -> DataFrame:
    return user_product_activity(events).join(segment_of_user(segments), "user_id", "inner")


def segment_activity(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Events per age group (events of known users only)."""
    return segment_activity_from(_joined(events, segments))


def segment_product_stats(events: DataFrame, segments: DataFrame) -> DataFrame:
    j = _joined(events, segments)
    stats = j.groupBy("age_group", "product_id").agg(
        *[F.sum(f"has_{s}").alias(name) for s, name in STAGE_COLS],
        F.sum("revenue").cast("double").alias("total_revenue"),
    )
    score = sum(F.col(c) * w for c, w in SCORE_WEIGHTS.items())
    return stats.withColumn("recommendation_score", score)


def recommend(events: DataFrame, segments: DataFrame, products: DataFrame,
              k: int = TOP_K) -> DataFrame:
    """Top-k products per age group with catalogue name/category/brand."""
    stats = segment_product_stats(events, segments)
    w = Window.partitionBy("age_group").orderBy(F.col("recommendation_score").desc(),
                                                F.col("product_id").asc_nulls_last())
    top = stats.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    # The ranked list (at most k rows per fixed band) is the streamed side and
    # is computed once; the compact catalogue projection is broadcast when its
    # estimated size is under the cap, else Spark shuffles the catalogue once
    # for a sort-merge join with the tiny list.
    cat = products.select("product_id", "product_name", "category_name", "brand")
    return top.join(cat, "product_id", "left").select(
        "age_group", "rank", "product_id", "views", "add_to_cart", "purchases",
        "total_revenue", "recommendation_score", "product_name", "category_name", "brand")


WIDE_FIELDS = ("product_id", "product_name", "score", "views", "add_to_cart", "purchases")


def recommendation_records(recs: DataFrame, run_id: str, created_at, k: int = TOP_K) -> DataFrame:
    """One wide serving row per segment: ``rank_<i>_<field>`` for i = 1..k;
    missing product name -> ``Unknown``; ranks beyond the segment's list are
    NULL."""
    r = recs.select("age_group", "rank", "product_id",
                    F.coalesce(F.col("product_name"), F.lit(UNKNOWN_NAME)).alias("product_name"),
                    F.col("recommendation_score").alias("score"),
                    "views", "add_to_cart", "purchases")
    # a segment's list, k entries at most, as a map from rank to its fields
    entry = F.struct("rank", F.struct(*WIDE_FIELDS))
    lists = r.filter(F.col("rank") <= k).groupBy("age_group").agg(F.map_from_entries(F.collect_list(entry)).alias("_of"))
    wide = lists.select("age_group", *[F.col("_of")[i][f].alias(f"rank_{i}_{f}")
                                       for i in range(1, k + 1) for f in WIDE_FIELDS])
    return wide.select(
        F.concat(F.lit(f"{run_id}_segment_"), F.col("age_group")).alias("row_key"),
        "age_group", F.lit("demographic").alias("segment_type"),
        ntz_lit(created_at).alias("created_at"),
        *[f"rank_{i}_{f}" for i in range(1, k + 1) for f in WIDE_FIELDS])


__all__ = ["user_segments", "user_product_activity", "segment_activity",
           "segment_of_user", "segment_product_stats", "recommend", "recommendation_records", "BAND_A_REST",
           "N_SEGMENTS"]
