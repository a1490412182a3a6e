from pyspark.sql import functions as F

from conftest import SF_SMALL, make_events

from clickflow.operators import dims
from clickflow.plans import serving as sv
from clickflow.sources import archive as ar
from clickflow.sources import files
from clickflow.sources import streams as st
from clickflow.sources.tables import Tables


def test_csv_round_trip_by_header(spark, scratch):
    # products written with category_code before price, read back by header name
    t = Tables(spark, SF_SMALL)
    prods = t.products().select("product_id", "product_name", "category_id", "category_name",
                                "category_code", "brand")
    dims.write_csv(prods, scratch + "/products")
    back = files.read_products(spark, scratch + "/products")
    assert back.count() == prods.count()
    assert back.schema["product_id"].dataType.simpleString() == "bigint"
    assert back.filter(F.col("product_id") == 1).first().brand == prods.filter(
        F.col("product_id") == 1).first().brand
    users = t.users()
    raw = users.select(F.col("user_id"), F.col("name").alias("Name"), F.lit("S").alias("Surname"),
                       F.col("birth_date").alias("Birth Date"), F.col("city").alias("City"),
                       F.lit("00-001").alias("Postal Code"), F.lit("Main").alias("Street Name"),
                       F.lit("1").alias("House Number"))
    ren = dims.rename_profile_columns(raw)
    assert ren.columns == ["name", "surname", "birth_date", "city", "zip_code", "street_name",
                           "house_number"]


def test_partitioned_sinks_and_external_table(spark, scratch):
    t = Tables(spark, SF_SMALL)
    dims.write_products(dims.clean_products(t.products()), scratch + "/catalogue")
    cat = spark.read.parquet(scratch + "/catalogue")
    assert cat.count() == t.products().count()
    assert cat.select("category_code").distinct().count() == 6
    msgs = st.to_messages(make_events(spark, [
        (1, "2024-03-01 10:00:00", 1, "view", 1, "c", "b", 1),
        (2, "2024-03-01 11:30:00", 1, "purchase", 1, "c", "b", 1)]))
    import datetime as dt
    path = scratch + "/events"
    ar.archive_hours(msgs, dt.datetime(2024, 3, 1, 10), dt.datetime(2024, 3, 1, 12), path)
    files.create_events_table(spark, "clickflow_events_t", path)
    parts = [r.partition for r in files.show_partitions(spark, "clickflow_events_t").collect()]
    assert parts == ["year=2024/month=03/day=01/hour=10", "year=2024/month=03/day=01/hour=11"]
    assert files.read_partition(spark, path, 2024, 3, 1, "purchase").count() == 1
    assert spark.table("clickflow_events_t").filter("hour = 11").count() == 1
    spark.sql("DROP TABLE clickflow_events_t")


def test_run_tables_keep_history(spark, scratch):
    rows = spark.createDataFrame([("k1", 1), ("k2", 2)], "row_key STRING, v INT")
    sv.write_run(rows, scratch + "/funnel", "20240101_000000")
    sv.write_run(rows.withColumn("v", F.col("v") * 10), scratch + "/funnel", "20240102_000000")
    sv.write_run(rows.withColumn("v", F.col("v") * 10), scratch + "/funnel", "20240102_000000")
    allv = spark.read.parquet(scratch + "/funnel")
    assert allv.count() == 4
    assert sorted(r.v for r in sv.latest_run(spark, scratch + "/funnel").collect()) == [10, 20]


def test_csv_folder_with_two_headers(spark, scratch):
    import pytest
    path = scratch + "/mixed"
    rows = spark.createDataFrame([(1, "Ann", "2000-01-01", "X"), (2, "Bob", None, "Y")],
                                 "user_id BIGINT, name STRING, birth_date STRING, city STRING")
    rest = [F.lit(None).cast("string").alias(c) for c in ("surname", "zip_code", "street_name", "house_number")]
    rows.filter("user_id = 1").select("user_id", "name", "birth_date", "city", *rest).coalesce(1).write.option(
        "header", "true").csv(path)
    rows.filter("user_id = 2").select("city", "name", *rest, "user_id", "birth_date").coalesce(1).write.mode(
        "append").option("header", "true").csv(path)
    got = files.read_csv_mixed(spark, path, files.USERS).select("user_id", "name", "city").orderBy("user_id").collect()
    assert [tuple(r) for r in got] == [(1, "Ann", "X"), (2, "Bob", "Y")]
    with pytest.raises(Exception, match="CSV|header"):       # never wrong rows without an error
        files.read_csv(spark, path, files.USERS).collect()


def test_describe_lists_columns_and_partitions(spark, scratch):
    msgs = st.to_messages(make_events(spark, [(1, "2024-01-01 10:00:00", 1, "view", 1, "c", "b", 1)]))
    from conftest import ts
    ar.archive_hours(msgs, ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00"), scratch + "/a")
    files.create_events_table(spark, "described", scratch + "/a")
    rows = [(r.col_name, r.data_type) for r in files.describe(spark, "described").collect()]
    spark.sql("DROP TABLE described")
    assert ("price", "double") in rows and ("hour", "int") in rows and ("Provider", "parquet") in rows
