"""Dimension building: demographics, product cleaning and naming,
keep-first dedup, positional zip, id extension.

Order-dependent steps of the original data preparation get an explicit
order column here; nothing relies on file order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.functions.demographics import age_band_b, calendar_age
from clickflow.plans.joins import extreme_rows


def user_demographics(users: DataFrame, as_of) -> DataFrame:
    """Users per (city, age_group) with calendar-year age, four bands."""
    age = calendar_age(F.col("birth_date"), as_of)
    return (users.select("city", age_band_b(age).alias("age_group"))
            .groupBy("city", "age_group").agg(F.count(F.lit(1)).alias("users_count")))


def clean_products(products_raw: DataFrame) -> DataFrame:
    """Products with a price and a category (filter pushed to the scan)."""
    return products_raw.filter(F.col("price").isNotNull() & F.col("category_code").isNotNull())


def distinct_categories(events: DataFrame) -> DataFrame:
    """Distinct (category_id, category_code) pairs of the event log."""
    return events.select(F.col("category_code").alias("category_id"), "category_code").distinct()


def first_per_key(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    """Keep the first row per ``key`` by ascending ``order`` (of rows that tie, the one that
    sorts first; rows without ``order`` don't count; NULL is a key)."""
    rows = df.select(key, F.col(order).alias("_by"), *[c for c in cols if c != key])
    return extreme_rows(rows, [key], F.col("_by"), newest=False).drop("_by")


def name_products(products: DataFrame, category_names: DataFrame,
                  product_names: DataFrame) -> DataFrame:
    """Attach category and product names by key (left joins)."""
    return (products.join(category_names.select("category_id", "category_name"), "category_id", "left")
                    .join(product_names.select("product_id", "product_name"), "product_id", "left"))


def positional_index(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based consecutive position of each row in ``order`` (ties broken by
    the remaining columns), computed without moving rows to one task.

    The range-sorted frame is tagged with partition id and in-partition
    position and checkpointed into the shared checkpoint folder, so both the
    per-partition counts and the final join read the same materialised rows.
    Offsets form a table of one row per partition, a bound set by the
    partition count, and are broadcast.
    """
    from clickflow.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)      # the session's shared folder (set only if unset)
    tie = [c for c in df.columns if c not in order]
    tagged = (df.orderBy(*order, *tie)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_mid") - F.col("_m0"))
                  .drop("_pid", "_mid", "_n", "_m0", "_off"))


def zip_frames(left: DataFrame, left_order: list[str], right: DataFrame,
               right_order: list[str]) -> DataFrame:
    """Row i of ``left`` next to row i of ``right``; the shorter side is
    NULL-padded (full outer join on position)."""
    a = positional_index(left, left_order, "_pos")
    b = positional_index(right, right_order, "_pos")
    return a.join(b, "_pos", "full_outer").drop("_pos")


def extend_ids(spark: SparkSession, ids: DataFrame, target_len: int | DataFrame,
               col: str = "user_id") -> DataFrame:
    """Existing ids plus consecutive new ids after the largest one until the
    frame has ``target_len`` rows (UNION ALL)."""
    # the ids feed both the scalars and the union: materialise them once;
    # two scalars reach the driver (max id, count), the rows never do
    from clickflow.plans.joins import materialize
    ids = materialize(ids.select(col))
    row = ids.agg(F.max(col).alias("mx"), F.count(F.lit(1)).alias("n")).first()
    target = target_len.count() if isinstance(target_len, DataFrame) else target_len
    missing = max(0, target - row["n"])
    start = (row["mx"] or 0) + 1
    new = spark.range(start, start + missing).select(F.col("id").cast(ids.schema[col].dataType).alias(col))
    return ids.select(col).unionByName(new)


# Profile column names of the raw user file and their
# snake_case names.
PROFILE_COLUMNS = {"Name": "name", "Surname": "surname", "Birth Date": "birth_date",
                   "City": "city", "Postal Code": "zip_code", "Street Name": "street_name",
                   "House Number": "house_number"}


def rename_profile_columns(raw_users: DataFrame) -> DataFrame:
    """Select the seven profile columns under snake_case names."""
    return raw_users.select(*[F.col(f"`{k}`").alias(v) for k, v in PROFILE_COLUMNS.items()])


def write_products(products: DataFrame, path: str) -> None:
    """Cleaned catalogue as Parquet partitioned by category_code (Snappy);
    the whole table is replaced, so a category that is gone doesn't stay."""
    (products.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .option("compression", "snappy").partitionBy("category_code").parquet(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line (one folder of part files)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
