"""Batch readers of the raw files and catalogue tables.

CSV is always read with an explicit schema by header name (no inference
pass over the data); external tables are declared over a location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickflow.sources.schemas import PRODUCTS, RAW_EVENT_CSV, USERS

EVENT_COLUMNS = ["event_time", "mapped_time", "event_type", "product_id", "category_id",
                 "category_code", "brand", "price", "user_id", "user_session"]


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """The columns of ``schema``, found by their names in the header, whatever its order; a value
    that doesn't parse is NULL. A file without one of the columns raises, and so does a folder
    whose files differ in their header (``read_csv_mixed`` reads those)."""
    raw = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    return _typed(raw, schema)


def _typed(raw: DataFrame, schema) -> DataFrame:
    return raw.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv_mixed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Like ``read_csv`` for a folder whose files differ in the order of their columns.

    The first line of each file is read (a limit of one line on every file, so no file is
    read through), and the files are read by groups of equal headers."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [str(f.getPath()) for f in fs.listStatus(p)
             if f.isFile() and f.getLen() > 0 and not f.getPath().getName().startswith(("_", "."))]
    heads: dict[str, list[str]] = {}
    for f in files:
        heads.setdefault(spark.read.text(f).first()[0], []).append(f)
    if not heads:
        return spark.createDataFrame([], schema)
    frames = [_typed(spark.read.option("header", "true").csv(group), schema) for group in heads.values()]
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other)
    return out


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USERS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, PRODUCTS)


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """Monthly raw CSV log, all columns as strings (cleaned by
    ``clickflow.functions.clean.clean_events``)."""
    return read_csv(spark, path, RAW_EVENT_CSV)


def read_events(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Archived event table (Parquet, Hive-partitioned by year/month/day/hour);
    only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*(columns or EVENT_COLUMNS))


def read_partition(spark: SparkSession, path: str, year: int, month: int, day: int,
                   event_type: str | None = None) -> DataFrame:
    """One day of the archive (partition-pruned), optionally one event type."""
    df = spark.read.parquet(path).filter(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("day") == day))
    if event_type:
        df = df.filter(F.col("event_type") == event_type)
    return df


def create_events_table(spark: SparkSession, name: str, path: str, discover: bool = True) -> None:
    """External partitioned Parquet table over the archive + partition
    discovery (without it, partitions are added by ``add_partition``)."""
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {name} (
        event_time STRING, event_type STRING, product_id BIGINT, category_id STRING,
        category_code STRING, brand STRING, price DOUBLE, user_id BIGINT,
        user_session STRING, original_time STRING, mapped_time STRING,
        processing_time STRING, kafka_timestamp BIGINT, kafka_partition BIGINT,
        year INT, month INT, day INT, hour INT)
      USING parquet PARTITIONED BY (year, month, day, hour) LOCATION '{path}'""")
    if discover:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def add_partition(spark: SparkSession, name: str, year: int, month: int, day: int,
                  hour: int, location: str) -> None:
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION "
              f"(year={year}, month={month}, day={day}, hour={hour}) LOCATION '{location}'")


def create_csv_table(spark: SparkSession, name: str, path: str, ddl: str) -> None:
    """Delimited external table with a header line."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING csv "
              f"OPTIONS (header 'true') LOCATION '{path}'")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE FORMATTED {name}")
