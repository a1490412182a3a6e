"""Scalar cleaning of raw rows (JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.functions.timefns import parse_time

# Strings that mean "missing" in the raw log.
MISSING_LABELS = ["", "NaN"]
UNKNOWN_LABEL = "unknown"
UNKNOWN_NAME = "Unknown"


def null_if_missing(c: Column) -> Column:
    """'' and 'NaN' to NULL."""
    return F.when(c.isNull() | c.isin(MISSING_LABELS), F.lit(None).cast("string")).otherwise(c)


def label_or_unknown(c: Column, label: str = UNKNOWN_LABEL) -> Column:
    """NULL or empty label to a default (Python truthiness maps '' too)."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(label))


def clean_events(raw: DataFrame) -> DataFrame:
    """Raw log rows (all strings) to typed events.

    category_code / brand: '' and 'NaN' to NULL; price: empty to 0.0;
    ids: empty or malformed to NULL; event_time parsed (bad -> NULL).
    """
    price = F.nullif(F.trim(F.col("price")), F.lit(""))
    return raw.select(
        F.col("event_time"),
        parse_time(F.col("event_time")).alias("event_timestamp"),
        F.col("event_type"),
        F.nullif(F.trim(F.col("product_id")), F.lit("")).try_cast("bigint").alias("product_id"),
        F.col("category_id"),
        null_if_missing(F.col("category_code")).alias("category_code"),
        null_if_missing(F.col("brand")).alias("brand"),
        F.coalesce(price.try_cast("double"), F.lit(0.0)).alias("price"),
        F.nullif(F.trim(F.col("user_id")), F.lit("")).try_cast("bigint").alias("user_id"),
        F.col("user_session"),
    )


def coerce_numeric(c: Column, default: float | None = 0.0) -> Column:
    """``to_numeric(errors='coerce')`` (+ fill): bad strings to NULL/default."""
    v = c.cast("string").try_cast("double")
    return v if default is None else F.coalesce(v, F.lit(default))


def day_of_log(event_time_str: Column) -> Column:
    """Day-of-month of a ``yyyy-MM-dd ...`` string (characters 9-10)."""
    return F.substring(event_time_str, 9, 2).try_cast("int")
