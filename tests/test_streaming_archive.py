import datetime as dt
import json
import os

from pyspark.sql import functions as F

from conftest import make_events, ts

from clickflow.operators import sliding as sl
from clickflow.plans.serving import VersionLog
from clickflow.sources import archive as ar
from clickflow.sources import streams as st
from clickflow.streaming import metrics as live


def _msg(event_time, etype, user, product=1, brand="acme", price=1.0):
    return json.dumps({"event_time": event_time, "event_type": etype, "product_id": product,
                       "category_code": "c", "brand": brand, "price": price, "user_id": user})


def _write_batch(spark, path, rows):
    df = spark.createDataFrame([(None, v, ts(b), 0) for v, b in rows],
                               "key STRING, value STRING, timestamp TIMESTAMP, partition INT")
    df.coalesce(1).write.mode("append").parquet(path)


def test_stream_late_data_and_parity(spark, scratch):
    src = scratch + "/in"
    # batch 1: events around 10:20
    _write_batch(spark, src, [(_msg("2024-01-01 10:20:00", "view", 1), "2024-01-01 10:20:00"),
                              (_msg("2024-01-01 10:21:30", "purchase", 2, price=3.5), "2024-01-01 10:21:30")])
    store = VersionLog(spark, scratch + "/store")
    ck = scratch + "/ck"
    msgs = st.event_stream(spark, fmt="parquet", path=src)
    live.run_available(spark, msgs, store, ck, metrics=("active_users", "event"), topk=None)
    # batch 2: one late event within the watermark (10:15 < 10:21:30 - 10 min? no:
    # watermark = 10:11:30, so 10:15 is kept) and one beyond it (10:05 is dropped)
    _write_batch(spark, src, [(_msg("2024-01-01 10:15:00", "view", 3), "2024-01-01 10:30:00"),
                              (_msg("2024-01-01 10:05:00", "view", 4), "2024-01-01 10:30:00"),
                              ("{not json", "2024-01-01 10:30:00")])   # bad_json: all-NULL row
    msgs = st.event_stream(spark, fmt="parquet", path=src)
    live.run_available(spark, msgs, store, ck, metrics=("active_users", "event"), topk=None)
    au = {r.window_start: (r.active_users, r.total_events) for r in store.latest("active_users").collect()}
    assert au[ts("2024-01-01 10:15:00")] == (1, 1)            # late but inside the watermark
    assert ts("2024-01-01 10:05:00") not in au               # beyond the watermark: dropped
    assert au[ts("2024-01-01 10:20:00")] == (2, 2)
    ev = {(r.window_start, r.event_type): r.event_count for r in store.latest("event").collect()}
    assert ev[(ts("2024-01-01 10:21:00"), "purchase")] == 1
    assert store.read("event").select("epoch_id").distinct().count() >= 2


def test_micro_batch_topk_is_global(spark):
    b = spark.createDataFrame(
        [(ts("2024-01-01 10:00:00"), i, "b", "c", 20 - i, 1.0) for i in range(15)],
        "window_start TIMESTAMP_NTZ, product_id BIGINT, brand STRING, category_code STRING, "
        "view_count BIGINT, avg_price DOUBLE").withColumn("window_end", F.col("window_start"))
    top = live.store_rows(b, "top_view", "micro_batch").collect()
    assert len(top) == 10 and {r["rank"] for r in top} == set(range(1, 11))
    assert {r.row_key for r in top} == {f"20240101_1000_top_view_{i}_b_c" for i in range(10)}


def test_decode_bad_json_and_wrong_type(spark):
    m = spark.createDataFrame([("{bad", dt.datetime(2024, 1, 1)),
                               ('{"event_type": "view", "user_id": "x", "price": 2.5}', dt.datetime(2024, 1, 1))],
                              "value STRING, timestamp TIMESTAMP")
    rows = st.decode(m).collect()
    assert rows[0].event_type is None and rows[0].user_id is None
    assert rows[1].user_id is None and rows[1].price == 2.5    # bad field only


def test_archive_hour_slices_and_idempotency(spark, scratch):
    # hour_slice + month_boundary: events at hh:00:00.000 of start and end
    rows = [(1, "2024-01-31 23:00:00", 1, "view", 1, "c", "b", 1),
            (2, "2024-01-31 23:59:59", 1, "view", 1, "c", "b", 1),
            (3, "2024-02-01 00:00:00", 2, "cart", 1, "c", "b", 1),
            (4, "2024-02-01 01:00:00", 2, "cart", 1, "c", "b", 1)]     # == end: excluded
    msgs = st.to_messages(make_events(spark, rows))
    path = scratch + "/archive"
    n = ar.archive_hours(msgs, ts("2024-01-31 23:00:00"), ts("2024-02-01 01:00:00"), path)
    assert n == 3
    assert sorted(os.listdir(path + "/year=2024")) == ["month=01", "month=02"]
    n2 = ar.archive_hours(msgs, ts("2024-01-31 23:00:00"), ts("2024-02-01 01:00:00"), path)
    assert n2 == 3
    v = {(r.month, r.day, r.hour): r.rows for r in ar.verify_archive(spark, path).collect()}
    assert v == {(1, 31, 23): 2, (2, 1, 0): 1}                # rewrite did not duplicate
    w = ar.read_window(spark, path, ts("2024-01-31 23:30:00"), ts("2024-02-01 00:30:00"))
    assert w.count() == 2                                      # across the month end


def test_to_messages_key_and_value(spark):
    ev = make_events(spark, [(1, "2024-01-01 10:00:00.123456", None, "view", 1, "c", "b", 2.5)])
    m = st.to_messages(ev).collect()[0]
    assert m.key is None
    body = json.loads(m.value)
    assert body["event_time"] == "2024-01-01 10:00:00.123456" and body["price"] == 2.5


def test_batch_equals_stream_on_driver_tables(spark):
    import __spark_entry__ as E
    q = E.queries()
    a = q["stream_event_distribution"](spark, "/root/testdata/sf0.001")
    b = q["sliding_event_distribution"](spark, "/root/testdata/sf0.001")
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
    n = sl.active_users(q["funnel_user_product"](spark, "/root/testdata/sf0.001")
                        .withColumnRenamed("view_time", "event_time")
                        .filter(F.col("event_time").isNotNull())).count()
    assert n > 0


def test_sink_json_fallback_when_store_fails(spark, scratch):
    blocker = os.path.join(scratch, "not_a_dir")
    with open(blocker, "w") as fh:                       # a file where the store folder should be
        fh.write("x")
    store = VersionLog(spark, blocker + "/store")
    batch = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1, 10, 5), "view", 3)],
        "window_start TIMESTAMP, window_end TIMESTAMP, event_type STRING, event_count BIGINT")
    sink = live.batch_sink(store, "event", "r", scratch + "/fallback", topk=None)
    sink(batch, 7)
    back = spark.read.json(scratch + "/fallback/event/batch_7").collect()
    assert len(back) == 1 and back[0].event_count == 3 and back[0].row_key == "20240101_1000_event_view"
    empty = batch.filter("event_count < 0")
    sink(empty, 8)                                       # empty micro-batch: nothing written
    assert not os.path.exists(scratch + "/fallback/event/batch_8")


def test_log_slice_half_open(spark, scratch):
    path = scratch + "/log"
    rows = [(None, "{}", dt.datetime(2024, 1, 1, 9, 59, 59), 0),
            (None, "{}", dt.datetime(2024, 1, 1, 10, 0, 0), 0),
            (None, "{}", dt.datetime(2024, 1, 1, 10, 59, 59), 1),
            (None, "{}", dt.datetime(2024, 1, 1, 11, 0, 0), 1)]
    spark.createDataFrame(rows, "key STRING, value STRING, timestamp TIMESTAMP, partition INT") \
        .write.parquet(path)
    start = int(dt.datetime(2024, 1, 1, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = st.log_slice(spark, start, start + 3600 * 1000, fmt="parquet", path=path)
    assert sorted(r.timestamp.minute for r in got.collect()) == [0, 59]


def test_live_queries_drain_stop_and_restart(spark, scratch):
    src = scratch + "/in"
    _write_batch(spark, src, [(_msg("2024-01-01 10:20:00", "view", 1), "2024-01-01 10:20:00")])
    store = VersionLog(spark, scratch + "/store")
    ck = scratch + "/ck"
    qs = live.start_metrics(st.event_stream(spark, fmt="parquet", path=src), store, ck,
                            metrics=("event",), topk=None, trigger={"processingTime": "1 second"})
    live.stop_metrics(qs)
    assert not any(q.isActive for q in qs)
    assert store.latest("event").count() == 5
    # restart from the same checkpoint: only the new file is processed
    _write_batch(spark, src, [(_msg("2024-01-01 10:20:30", "view", 2), "2024-01-01 10:20:30")])
    qs = live.start_metrics(st.event_stream(spark, fmt="parquet", path=src), store, ck,
                            metrics=("event",), topk=None, trigger={"processingTime": "1 second"})
    live.stop_metrics(qs)
    counts = {r.window_start: r.event_count for r in store.latest("event").collect()}
    assert counts[ts("2024-01-01 10:20:00")] == 2 and len(counts) == 5


def test_event_time_lookback_finds_late_messages(spark, scratch):
    """A message that reached the broker two days late is found by its event time, also in an
    archive that has no zone map."""
    rows = spark.createDataFrame([
        ("view", "2024-01-10 08:00:00", 1, 2024, 1, 10), ("late", "2024-01-10 09:00:00", 2, 2024, 1, 12),
        ("edge", "2024-01-11 00:00:00", 3, 2024, 1, 11), ("before", "2024-01-09 23:59:59", 4, 2024, 1, 10),
        ("after", "2024-01-11 00:00:01", 5, 2024, 1, 11), ("bad", "no time", 6, 2024, 1, 11),
        ("old", "2024-01-01 00:00:00", 7, 2024, 1, 1)],
        "event_type STRING, mapped_time STRING, user_id BIGINT, year INT, month INT, day INT")
    path = scratch + "/archive"
    rows.write.partitionBy("year", "month", "day").parquet(path)
    start, end = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 11)
    both = ar.read_event_time(spark, path, start, end)
    assert {r.event_type for r in both.collect()} == {"view", "late", "edge"}
    assert {r.event_type for r in ar.read_event_time(spark, path, start).collect()} == {
        "view", "late", "edge", "after"}


def _skewed(spark):
    """(event time, broker time, type): on time, a day late, a day ahead, and beyond a second look-back."""
    rows = [("2024-01-29 12:00:00", "2024-01-29 12:00:00", "before"), ("2024-01-30 00:00:05", "2024-01-29 23:00:00", "ahead"),
            ("2024-01-30 10:00:00", "2024-01-29 09:00:00", "day_ahead"), ("2024-01-30 11:00:00", "2024-01-31 12:00:00", "day_late"),
            ("2024-01-30 12:00:00", "2024-01-30 12:00:00", "on_time"), ("2024-02-02 00:00:00", "2024-02-02 00:30:00", "after")]
    ev = spark.createDataFrame([(i, ts(e), i, k, 1, "c", "b", None, ts(b)) for i, (e, b, k) in enumerate(rows)],
                               "event_id BIGINT, event_time TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
                               "product_id BIGINT, category_code STRING, brand STRING, price DECIMAL(18,2), "
                               "broker_time TIMESTAMP_NTZ")
    return st.to_messages(ev, "broker_time")


def test_zone_map_prunes_without_loss(spark, scratch):
    path = scratch + "/archive"
    assert ar.archive_hours(_skewed(spark), ts("2024-01-29 00:00:00"), ts("2024-02-03 00:00:00"), path) == 6
    start, end = dt.datetime(2024, 1, 30), dt.datetime(2024, 1, 31)
    found = ar.read_event_time(spark, path, start, end)
    assert {r.event_type for r in found.collect()} == {"ahead", "day_ahead", "day_late", "on_time"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    zones = {(r.day, r.hour): (r.low, r.rows) for r in ar.hour_zones(spark, path).filter("NOT open").collect()}
    assert zones[29, 9] == (ts("2024-01-30 10:00:00"), 1) and len(zones) == 6
    # of the six hours four may hold such events
    mapped = ar.hour_zones(spark, path).filter("NOT open")
    assert mapped.filter(F.col("high") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")).filter(
        F.col("low") <= F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")).count() == 4
    # an hour that is open, its bounds unknown, is read
    ar._open_hours(spark, path, ts("2024-02-02 00:00:00"), ts("2024-02-02 01:00:00"), 99)
    late = ar.read_event_time(spark, path, dt.datetime(2024, 2, 2))
    assert {r.event_type for r in late.collect()} == {"after"}


def test_archive_replaces_hours_and_indexes_old_archives(spark, scratch):
    path = scratch + "/archive"
    msgs = _skewed(spark)
    lo, hi = ts("2024-01-29 00:00:00"), ts("2024-02-03 00:00:00")
    ar.archive_hours(msgs, lo, hi, path)
    # an archive written before there were zone maps gets one from its files
    import shutil
    shutil.copytree(path, scratch + "/old", ignore=shutil.ignore_patterns("_zones"))
    assert ar.hour_zones(spark, scratch + "/old") is None
    fewer = msgs.filter("value NOT LIKE '%day_late%'")
    for p in (path, scratch + "/old"):
        assert ar.archive_hours(fewer, lo, hi, p) == 5
        assert spark.read.parquet(p).count() == 5                    # the hour without messages is gone
        assert ar.archive_hours(msgs.limit(0), ts("2024-01-29 00:00:00"), ts("2024-01-30 00:00:00"), p) == 0
        left = {r.event_type for r in spark.read.parquet(p).collect()}
        assert left == {"on_time", "after"}
        assert {r.event_type for r in ar.read_event_time(spark, p, dt.datetime(2024, 1, 30)).collect()} == left


class _Broken(VersionLog):
    def __init__(self, spark, root, epochs):
        super().__init__(spark, root)
        self.epochs = epochs

    def write(self, rows, metric, run_id, epoch_id, created_at=None):
        if epoch_id in self.epochs:
            raise OSError("not available")
        super().write(rows, metric, run_id, epoch_id, created_at)


def _views(spark, rows):
    """(product, count) of one window as a micro-batch's output."""
    return spark.createDataFrame([(ts("2024-01-01 10:00:00"), ts("2024-01-01 10:05:00"), p, "b", "c", n, 1.5)
                                  for p, n in rows],
                                 "window_start TIMESTAMP, window_end TIMESTAMP, product_id BIGINT, brand STRING, "
                                 "category_code STRING, view_count BIGINT, avg_price DOUBLE")


LISTS = [[(p, p) for p in range(1, 16)], [(p, 100 - p) for p in range(10, 25)], [(3, 7), (12, 9)]]


def test_lists_leave_tombstones(spark, scratch):
    store = VersionLog(spark, scratch + "/store")
    sink = live.batch_sink(store, "top_view", "r", None)
    want = [{p: i + 1 for i, (p, _) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0]))[:10])} for rows in LISTS]
    for epoch, rows in enumerate(LISTS):
        for _ in range(2 if epoch == 1 else 1):      # an epoch that is written again changes nothing
            sink(_views(spark, rows), epoch)
        assert {r.product_id: r["rank"] for r in store.latest("top_view").collect()} == want[epoch]
    live.batch_sink(store, "top_view", "another run", None)(_views(spark, [(77, 1)]), 0)
    assert [r.product_id for r in store.latest("top_view").collect()] == [77]


def test_fallback_is_reconciled_by_epoch(spark, scratch):
    for broken in ({1}, {0, 2}, {0, 1, 2}):
        root = f"{scratch}/{len(broken)}{max(broken)}"
        store = VersionLog(spark, root + "/store")
        sink = live.batch_sink(_Broken(spark, store.root, broken), "top_view", "r", root + "/fallback")
        for epoch, rows in enumerate(LISTS):
            sink(_views(spark, rows), epoch)
        for _ in range(2):      # doing it again changes nothing
            assert live.reconcile_fallback(store, "top_view", "r", root + "/fallback") == sorted(broken)
            assert {r.product_id: (r["rank"], r.avg_price) for r in store.latest("top_view").collect()} == {
                12: (1, 1.5), 3: (2, 1.5)}
    assert live.reconcile_fallback(store, "event", "r", root + "/fallback") == []


def test_one_failing_query_lets_the_others_finish(spark, scratch):
    src = scratch + "/in"
    _write_batch(spark, src, [(_msg(f"2024-01-01 10:{m:02d}:00", "view", m), "2024-01-01 10:20:00") for m in range(5)])
    store = _Broken(spark, scratch + "/store", set())
    store.write = lambda rows, metric, *a, **k: (_ for _ in ()).throw(OSError("no space")) if metric == "brand" else (
        VersionLog.write(store, rows, metric, *a, **k))
    watch = live.StreamWatch()
    spark.streams.addListener(watch)
    try:
        qs = live.start_metrics(st.event_stream(spark, fmt="parquet", path=src), store, scratch + "/ck",
                                ("brand", "event", "active_users"), topk=None, state_partitions=2)
        failed = live.await_all(qs)      # without end but for the failure
        watch.settle(qs)
    finally:
        spark.streams.removeListener(watch)
    assert set(failed) == {"live_brand_live"} and "live_brand_live" in watch.failed and "no space" in failed["live_brand_live"]
    assert not any(q.isActive for q in qs)
    assert sum(r.event_count for r in store.latest("event").collect()) == 25
    assert store.latest("active_users").count() == 9


def test_dropped_rows_are_counted(spark, scratch):
    src = scratch + "/in"
    for batch in (["10:20", "10:21"], ["10:22"], ["10:05", "10:15", "10:25"]):
        _write_batch(spark, src, [(_msg(f"2024-01-01 {t}:00", "view", 1), "2024-01-01 10:30:00") for t in batch])
    store = VersionLog(spark, scratch + "/store")
    msgs = st.event_stream(spark, fmt="parquet", path=src, options={"maxFilesPerTrigger": "1"})
    watch = live.run_available(spark, msgs, store, scratch + "/ck", ("event",), topk=None, state_partitions=2)
    # late rows of the third batch are told by 10:11, what the second started with: all five windows of 10:05 are
    # dropped, and none of 10:15, which end from 10:16 on
    assert watch.dropped["live_event_replay"] == 5
    kept = {r.window_start.strftime("%H:%M"): r.event_count for r in store.latest("event").collect()}
    assert kept["10:11"] == 1 and "10:05" not in kept and sum(kept.values()) == 5 * 5
