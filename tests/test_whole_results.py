"""No cut between an operator and its report: NULL and colliding keys, more brands
and products than any list is long, users listed twice, odd key prefixes, fresh
file listings, scratch folders."""

import pytest
from pyspark.sql import functions as F

from conftest import make_events, make_users, ts

from clickflow.operators import brands as br, profile as pf
from clickflow.plans import reports as rp, serving as sv
from clickflow.sources.tables import Tables, events_from_tables


def versions(df, metric):
    return df.withColumn("row_key", sv.row_key(metric)).withColumn("created_at", F.current_timestamp()).withColumn(
        "epoch_id", F.lit(1))


def test_keys_hold_the_whole_grouping(spark):
    t = ts("2024-01-01 10:00:00")
    views = spark.createDataFrame(
        [(t, p, b, c) for p in (1, None) for b in ("a", "a_b", None, "\\N") for c in ("x", "b_x", None, "_")],
        "window_start TIMESTAMP_NTZ, product_id BIGINT, brand STRING, category_code STRING")
    assert sv.latest(versions(views, "top_view")).count() == views.count() == 32
    mix = spark.createDataFrame([(ts(f"2024-01-01 10:{m:02}:00"), e) for m in range(10) for e in ("view", None, "a_b", "null")],
                                "window_start TIMESTAMP_NTZ, event_type STRING")
    assert sv.latest(versions(mix, "event")).count() == 40
    brand = spark.createDataFrame([(t, "a_b", "c"), (t, "a", "b_c"), (t, None, "c"), (t, "a\\_b", "c")],
                                  "window_start TIMESTAMP_NTZ, brand STRING, event_type STRING")
    assert sv.latest(versions(brand, "brand")).count() == 4


def test_prefix_scan_keeps_every_key(spark):
    keys = ["20240101_1000_brand_żubr", "20240101_1000_brand_~x", "20240101_1000_brand_a", "20240231_x", "2024"]
    df = spark.createDataFrame([(k, "2024-01-01" if k != "20240231_x" else None) for k in keys], "row_key STRING, d STRING").select(
        "row_key", F.to_date("d").alias("window_date"))
    assert sv.prefix_scan(df, "20240101_1000_brand_").count() == 3
    assert [r.row_key for r in sv.prefix_scan(df, "20240231_").collect()] == ["20240231_x"]


def test_reports_see_all_brands(spark):
    rows = [(i, "2024-01-01 10:00:00", i % 7, "purchase", i, "c", f"b{i:03}", 1 + i) for i in range(150)]
    users = make_users(spark, [(i, "n", "1990-01-01", "x") for i in range(7)])
    m = br.brand_age_metrics(make_events(spark, rows), users, "2024-02-01")
    total = rp.brand_grand_totals(br.brand_records(m, "run", "2024-02-01", n=None)).collect()[0]
    assert total["brands"] == 150
    assert br.brand_records(m, "run", "2024-02-01").select("brand").distinct().count() == 100


def test_latest_products_come_from_all_products(spark):
    rows, n = [], 0
    for p in range(30):  # thirty products in one window, ever fewer views
        for _ in range(40 - p):
            rows.append((n, "2024-01-01 10:02:30", 1, "view", p, "c", "b", 1))
            n += 1
    got = rp.top_products_latest(make_events(spark, rows), k=25).collect()
    assert [r.product_id for r in got] == list(range(25))


def test_a_user_listed_twice_is_one_user(spark):
    ev = make_events(spark, [(1, "2024-01-01 10:00:00", 1, "view", 1, "c", "acme", 1), (2, "2024-01-01 10:01:00", 1, "purchase", 1, "c", "acme", 5)])
    users = make_users(spark, [(1, "a", "1990-01-01", "x"), (1, "a", "1990-01-01", "x")])
    r = br.brand_age_metrics(ev, users, "2024-02-01").collect()
    assert [(x.unique_users, x.total_views, x.total_purchases, x.total_revenue) for x in r] == [(1, 1, 1, 5.0)]


def test_other_event_types_stay(spark):
    events = spark.createDataFrame([(i, ts("2024-01-01 10:00:00"), 1, e, 1.0, None) for i, e in enumerate(
        ("view", "click", "signup", "error", None))],
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    part = spark.createDataFrame([], "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE")
    got = {r.event_type: r.event_count for r in pf.event_type_distribution(events_from_tables(events, part)).collect()}
    assert got == {"view": 1, "cart": 1, "signup": 1, "error": 1, None: 1}


def test_purchases_after_the_evaluation_time_count(spark):
    ev = make_events(spark, [(i, f"2024-01-{d:02} 10:00:00", 1, "purchase", 1, "c", "b", 1) for i, d in enumerate((1, 9, 10, 12))])
    assert pf.recent_purchases(ev, "2024-01-10 12:00:00", hours=48).collect()[0].purchase_count == 3


def test_tables_list_files_afresh(spark, scratch):
    spark.range(10).write.parquet(f"{scratch}/events.parquet")
    assert Tables(spark, scratch).raw("events").count() == 10
    spark.range(10).write.mode("append").parquet(f"{scratch}/events.parquet")
    assert Tables(spark, scratch).raw("events").count() == 20


def test_no_local_scratch_on_a_cluster():
    from clickflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_csv_columns_by_name(spark, scratch):
    from clickflow.sources.files import read_users
    from clickflow.sources.schemas import USERS
    names = [f.name for f in USERS.fields]
    row = spark.range(1).select(*[F.lit("7" if f.dataType.simpleString() in ("bigint", "int") else None).cast(f.dataType).alias(f.name)
                                  for f in USERS.fields])
    row.select(*reversed(names)).withColumn("extra", F.lit("x")).write.option("header", "true").csv(f"{scratch}/u")
    got = read_users(spark, f"{scratch}/u")
    assert got.columns == names and got.collect() == row.collect()


def test_catalogue_is_replaced(spark, scratch):
    from clickflow.operators.dims import write_products
    for rows in ([(1, "a"), (2, "b")], [(1, "a")]):
        write_products(spark.createDataFrame(rows, "product_id BIGINT, category_code STRING"), f"{scratch}/p")
    assert spark.read.parquet(f"{scratch}/p").count() == 1


def test_archive_rerun_replaces_its_hours(spark, scratch):
    import datetime as dt

    from clickflow.sources import archive as ar, streams as st
    ev = make_events(spark, [(i, f"2024-01-01 {10 + i % 3}:00:{i % 60:02}", 1, "view", 1, "c", "b", 1) for i in range(300)])
    path = f"{scratch}/a"
    msgs = st.to_messages(ev).repartition(8)
    day = dt.datetime(2024, 1, 1)
    assert ar.archive_hours(msgs, day.replace(hour=10), day.replace(hour=13), path) == 300
    seen = ar.verify_archive(spark, path).collect()
    assert len(seen) == 3 and sum(r.rows for r in seen) == 300 and all(r.files == 1 for r in seen)
    assert ar.archive_hours(msgs.limit(0), day.replace(hour=11), day.replace(hour=12), path) == 0
    assert {r.hour: r.rows for r in ar.verify_archive(spark, path).collect()} == {10: 100, 12: 100}
