"""Adapter from the driver's star-schema tables to the commerce data model.

The driver tables carry no brand, price or session on ``events``, so the
commerce event view is derived: ``click`` plays ``cart``, every other type
keeps its own name, the product comes from ``props`` (``{"k": n}``) and
brand / category from ``part``. Users come from ``customer`` with a
deterministic birth date and the nation name as city. A second adapter turns
order lines into purchase events so purchase-side metrics run at the size of
``lineitem``.

No join carries a broadcast hint: adaptive execution broadcasts a dimension that
turns out small at run time and otherwise splits the hot partitions of the
sort-merge join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (must equal the oracle SQL).
EVENT_TYPE_MAP = {"click": "cart"}
BIRTH_YEAR_BASE = 1950
BIRTH_YEAR_SPAN = 56
PRICE_TYPE = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _product_from_props(props: Column) -> Column:
    return F.regexp_extract(props, "[0-9]+", 0).try_cast("bigint")


def products_from_part(part: DataFrame) -> DataFrame:
    """Catalogue: product_id, product_name, category_id, category_name,
    category_code, brand, price."""
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_id"),
        F.col("p_type").alias("category_name"),
        F.col("p_type").alias("category_code"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
    )


def events_from_tables(events: DataFrame, part: DataFrame | None) -> DataFrame:
    """Commerce events: event_id, event_time (TIMESTAMP_NTZ), user_id,
    event_type (view/cart/purchase and others), product_id, category_code, brand,
    price DECIMAL(18,2). Without ``part`` there is no catalogue join and no
    category_code and brand."""
    kind = F.col("event_type")
    for source, name in EVENT_TYPE_MAP.items():
        kind = F.when(F.col("event_type") == source, name).otherwise(kind)
    ev = (events
          .select(
              "event_id",
              F.col("ts").alias("event_time"),
              "user_id",
              kind.alias("event_type"),
              _product_from_props(F.col("props")).alias("product_id"),
              F.col("value").cast(PRICE_TYPE).alias("price"),
          ))
    if part is None:
        return ev
    dims = part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_type").alias("category_code"),
                       F.col("p_brand").alias("brand"))
    return (ev.join(dims, "product_id", "left")
              .select("event_id", "event_time", "user_id", "event_type",
                      "product_id", "category_code", "brand", "price"))


def users_from_tables(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Users: user_id, name, birth_date, city (nation name)."""
    key = F.col("c_custkey")
    birth = F.make_date((F.lit(BIRTH_YEAR_BASE) + key % BIRTH_YEAR_SPAN).cast("int"),
                        (F.lit(1) + key % 12).cast("int"),
                        (F.lit(1) + key % 28).cast("int"))
    nat = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city"))
    return (customer.join(nat, "c_nationkey", "inner")
                    .select(key.alias("user_id"), F.col("c_name").alias("name"),
                            birth.alias("birth_date"), "city"))


def order_purchases(lineitem: DataFrame, orders: DataFrame, part: DataFrame | None) -> DataFrame:
    """Order lines as purchase events (same columns as ``events_from_tables``; without
    ``part`` no category_code and brand).

    lineitem x orders is a fact-to-fact join: it shuffles both sides on the
    order key (sort-merge); AQE splits skewed order keys.
    """
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    od = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lines = (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
               .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
                       F.col("o_orderdate").alias("event_time"),
                       F.col("o_custkey").alias("user_id"),
                       F.lit("purchase").alias("event_type"),
                       F.col("l_partkey").alias("product_id"),
                       F.col("l_extendedprice").cast(PRICE_TYPE).alias("price")))
    if part is None:
        return lines
    dims = part.select(F.col("p_partkey").alias("product_id"),
                       F.col("p_type").alias("category_code"),
                       F.col("p_brand").alias("brand"))
    return (lines.join(dims, "product_id", "left")
                 .select("event_id", "event_time", "user_id", "event_type",
                         "product_id", "category_code", "brand", "price"))


class Tables:
    """Lazy accessors for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    def events(self) -> DataFrame:
        return events_from_tables(self.raw("events"), self.raw("part"))

    def plain_events(self) -> DataFrame:
        """Events for queries that name no catalogue column: no catalogue join."""
        return events_from_tables(self.raw("events"), None)

    def users(self) -> DataFrame:
        return users_from_tables(self.raw("customer"), self.raw("nation"))

    def products(self) -> DataFrame:
        return products_from_part(self.raw("part"))

    def order_events(self) -> DataFrame:
        return order_purchases(self.raw("lineitem"), self.raw("orders"), self.raw("part"))

    def plain_order_events(self) -> DataFrame:
        """Order lines for queries that name no catalogue column: no catalogue join."""
        return order_purchases(self.raw("lineitem"), self.raw("orders"), None)
