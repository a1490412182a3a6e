"""Event-log profiles: type distribution, per-day / per-hour counts,
distinct counts, freshness bounds. All single-pass aggregates with
map-side combine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickflow.functions.timefns import between_closed, since


def event_type_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))


def events_per_day(events: DataFrame, ts: str = "event_time") -> DataFrame:
    return (events.groupBy(F.to_date(F.col(ts)).alias("day"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def events_per_hour(events: DataFrame, ts: str = "event_time") -> DataFrame:
    return (events.groupBy(F.hour(F.col(ts)).alias("hour"))
            .agg(F.count(F.lit(1)).alias("event_count")))


def _distinct_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """One row: how many different whole numbers ``col`` holds (NULL not counted), and the rows.

    64 neighbouring ids share one word, an id is one of its bits: words are combined by a
    hash aggregate before the shuffle (the bitmap functions over larger buckets hold binary
    buffers, which Spark aggregates by sorting), and the counts of their bits add up."""
    id_ = F.col(col).cast("bigint")
    words = df.groupBy(F.shiftright(id_, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), id_.bitwiseAND(63).cast("int"))).alias("bits"),
        F.count(F.lit(1)).alias("rows"))
    return words.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("bigint").alias(name),
                     F.coalesce(F.sum("rows"), F.lit(0)).alias("events"))


def distinct_counts(events: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """Distinct products, categories, users, brands (NULL not counted) and events.

    Ids are counted by bitmaps, each from a scan of its own column; labels by their
    distinct values. With ``catalogue`` (product_id, category_code, brand; one row per
    product) the labels are those of the products that occur, so events join nothing."""
    users = _distinct_ids(events.select("user_id"), "user_id", "users")
    products = _distinct_ids(events.select("product_id"), "product_id", "products").drop("events")
    labels = events if catalogue is None else events.select("product_id").distinct().join(
        catalogue.select("product_id", "category_code", "brand"), "product_id")
    pairs = labels.select("category_code", "brand").distinct()
    one = lambda c, name: pairs.select(c).dropna().distinct().agg(F.count(F.lit(1)).alias(name))
    # four frames of one row each
    return (users.crossJoin(products).crossJoin(one("category_code", "categories")).crossJoin(one("brand", "brands"))
            .select("products", "categories", "users", "brands", "events"))


def lookback_distribution(events: DataFrame, as_of, hours: float = 24, ts: str = "event_time") -> DataFrame:
    """Event-type distribution of the look-back ``ts >= as_of - hours``."""
    return event_type_distribution(events.filter(since(F.col(ts), as_of, hours=hours)))


def recent_purchases(events: DataFrame, as_of, hours: float = 24, ts: str = "event_time") -> DataFrame:
    """Purchases since ``as_of - hours`` (no upper bound): count, first and last time."""
    p = events.filter((F.col("event_type") == "purchase") & since(F.col(ts), as_of, hours=hours))
    return p.agg(F.count(F.lit(1)).alias("purchase_count"),
                 F.min(ts).alias("min_time"), F.max(ts).alias("max_time"))
