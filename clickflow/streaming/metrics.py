"""Live metrics as Structured Streaming queries.

Messages are decoded once; each metric is its own query (watermark 10
minutes on event time, 5 minute windows sliding by 1 minute, update output
mode) writing every micro-batch through ``foreachBatch`` into the version
log. The sink is a distributed DataFrame write (no collect), keyed by
``run_id/epoch_id``, so the at-least-once replay of an epoch is idempotent.
If the store write fails the batch goes to a JSON fallback folder, with the time of
its version, and ``reconcile_fallback`` brings it into the store afterwards.

Top lists (products, brands) follow the original sink: one global top-10
over all windows updated in the micro-batch (``topk="micro_batch"``). Rows that
leave the list are written again, marked ``removed``, so the latest view of the store
holds the newest list alone. With ``topk=None`` every updated row is stored and
per-window top lists are computed on read
(``clickflow.operators.sliding.per_window_topk`` over the latest view).

Several metrics run under one wait (``await_all``): when one fails the others finish
what is available, and ``StreamWatch`` tells which failed and how many rows the
watermark dropped.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from clickflow.functions.timefns import ntz_lit
from clickflow.operators import sliding as sl
from clickflow.plans.joins import materialize
from clickflow.plans.serving import VersionLog, row_key
from clickflow.sources.streams import decode, with_event_timestamp

log = logging.getLogger(__name__)

TS = "event_timestamp"

# metric -> (aggregate, top-k order column, top-k tie-break columns)
METRIC_SPECS: dict[str, tuple[Callable[..., DataFrame], str | None, list[str]]] = {
    "active_users": (sl.active_users, None, []),
    "top_view": (sl.product_views, "view_count", ["product_id", "brand", "category_code"]),
    "purchases": (sl.purchases, None, []),
    "event": (sl.event_distribution, None, []),
    "brand": (sl.brand_activity, "event_count", ["brand", "event_type"]),
}


# Rows of the serving store by metric (the fallback's JSON is read back with these types).
_WINDOW = "row_key STRING, window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ"
_LIST = "rank INT, removed BOOLEAN"
STORED = {
    "active_users": f"{_WINDOW}, active_users BIGINT, total_events BIGINT",
    "top_view": f"{_WINDOW}, product_id BIGINT, brand STRING, category_code STRING, view_count BIGINT, "
                f"avg_price DOUBLE, {_LIST}",
    "purchases": f"{_WINDOW}, purchase_count BIGINT, total_revenue DOUBLE, avg_basket_value DOUBLE, "
                 "purchasing_users BIGINT",
    "event": f"{_WINDOW}, event_type STRING, event_count BIGINT",
    "brand": f"{_WINDOW}, brand STRING, event_type STRING, event_count BIGINT, total_value DOUBLE, {_LIST}",
}
JSON_TIME = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def live_events(messages: DataFrame) -> DataFrame:
    """Decoded events with a TIMESTAMP event time and the watermark set."""
    ev = with_event_timestamp(decode(messages))
    return ev.withWatermark(TS, sl.WATERMARK)


def metric_stream(events: DataFrame, metric: str) -> DataFrame:
    fn = METRIC_SPECS[metric][0]
    return fn(events, ts=TS, mode="stream")


def store_rows(batch: DataFrame, metric: str, topk: str | None = "micro_batch") -> DataFrame:
    """Micro-batch output -> serving rows (row_key, NTZ window bounds,
    metrics, optional rank)."""
    _, by, tie = METRIC_SPECS[metric]
    df = batch.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
              .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))
    if by and topk == "micro_batch":
        df = sl.micro_batch_topk(df, by, ["window_start", *tie]).withColumn("removed", F.lit(False))
    return df.withColumn("row_key", row_key(metric))


def with_left_rows(rows: DataFrame, store: VersionLog, metric: str, run_id: str, epoch_id: int) -> DataFrame:
    """A top list and, marked as removed, the rows of the list before that it no longer holds
    (two lists of ten rows or so)."""
    before = store.last_list(metric, run_id, epoch_id)
    if before is None:
        return rows
    left = before.select(*[c for c in rows.columns]).join(rows.select("row_key"), "row_key", "left_anti")
    return rows.unionByName(left.withColumn("rank", F.lit(None).cast("int")).withColumn("removed", F.lit(True)))


def batch_sink(store: VersionLog, metric: str, run_id: str, fallback: str | None,
               topk: str | None = "micro_batch"):
    def write(batch: DataFrame, epoch_id: int) -> None:
        # The micro-batch output (groups updated in this trigger) is used by
        # more than one action below; keep it for the callback so the batch
        # plan runs once.
        batch.persist()
        try:
            if batch.isEmpty():
                return
            rows = store_rows(batch, metric, topk)
            try:
                if "removed" in rows.columns:
                    rows = with_left_rows(rows, store, metric, run_id, epoch_id)
                store.write(rows, metric, run_id, epoch_id)
            except Exception:  # keep the batch: JSON fallback
                if not fallback:
                    raise
                log.exception("serving write failed for %s epoch %s", metric, epoch_id)
                (rows.withColumn("created_at", F.current_timestamp().cast("timestamp_ntz"))
                 .write.mode("overwrite").options(**JSON_TIME).json(f"{fallback}/{metric}/batch_{epoch_id}"))
        finally:
            batch.unpersist()
    return write


def reconcile_fallback(store: VersionLog, metric: str, run_id: str, fallback: str) -> list[int]:
    """Write every fallback batch of ``metric`` into the store as the epoch it was, with the time
    it failed at, so that later epochs stay newer; returns the epochs. Doing it again changes
    nothing: an epoch's partitions are replaced."""
    spark = store.spark
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{fallback}/{metric}/batch_*")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    epochs = sorted(int(str(f.getPath().getName()).removeprefix("batch_")) for f in found)
    for epoch in epochs:
        rows = (spark.read.schema(f"{STORED[metric]}, created_at TIMESTAMP_NTZ").options(**JSON_TIME)
                .json(f"{fallback}/{metric}/batch_{epoch}"))
        time = F.col("created_at")
        if "removed" in rows.columns and rows.filter("removed IS NOT NULL").isEmpty():
            rows = rows.drop("rank", "removed")     # stored whole, without lists
        if "removed" not in rows.columns:
            store.write(rows, metric, run_id, epoch, created_at=time)
            continue
        # a list's own marks, and those of the list after it, which knew only the list before
        stamp = rows.agg(F.max("created_at")).first()[0]
        listed = with_left_rows(materialize(rows.drop("created_at")), store, metric, run_id, epoch)
        store.write(materialize(listed), metric, run_id, epoch, created_at=ntz_lit(stamp))
        after = store.read(metric).filter((F.col("run_id") == run_id) & (F.col("epoch_id") > epoch))
        following = after.agg(F.min("epoch_id")).first()[0]
        if following is not None:
            later = materialize(after.filter((F.col("epoch_id") == following) & ~F.col("removed")))
            stamp = later.agg(F.max("created_at")).first()[0]
            listed = with_left_rows(later.select(*rows.drop("created_at").columns), store, metric, run_id, following)
            store.write(materialize(listed), metric, run_id, following, created_at=ntz_lit(stamp))
    return epochs


def start_metrics(messages: DataFrame, store: VersionLog, checkpoint_root: str,
                  metrics: tuple[str, ...] = tuple(METRIC_SPECS), run_id: str = "live",
                  fallback: str | None = None, topk: str | None = "micro_batch",
                  trigger: dict | None = None,
                  state_partitions: int | None = None) -> list[StreamingQuery]:
    """Start one streaming query per metric; returns the handles (wait with ``await_all``).

    ``state_partitions`` sizes the shuffle / state-store partitions of a new
    checkpoint (a stream keeps the count of its first run); the session
    value is used when not given. Each query copies the session settings at
    start, so the value is applied only while starting.
    """
    spark = messages.sparkSession
    events = live_events(messages)
    queries = []
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    try:
        if state_partitions:
            spark.conf.set(key, str(state_partitions))
        for m in metrics:
            w = (metric_stream(events, m).writeStream.outputMode("update")
                 .queryName(f"live_{m}_{run_id}")
                 .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/{m}")
                 .foreachBatch(batch_sink(store, m, run_id, fallback, topk)))
            if trigger:
                w = w.trigger(**trigger)
            queries.append(w.start())
    finally:
        spark.conf.set(key, before)
    return queries


def run_available(spark: SparkSession, messages: DataFrame, store: VersionLog,
                  checkpoint_root: str, metrics: tuple[str, ...] = tuple(METRIC_SPECS),
                  run_id: str = "replay", topk: str | None = "micro_batch",
                  state_partitions: int | None = None, fallback: str | None = None) -> StreamWatch:
    """Process everything available now and stop (bounded replay); returns what was watched.
    A metric that fails raises once the others are done."""
    watch = StreamWatch()
    spark.streams.addListener(watch)
    try:
        qs = start_metrics(messages, store, checkpoint_root, metrics, run_id, fallback=fallback,
                           topk=topk, trigger={"availableNow": True},
                           state_partitions=state_partitions)
        failed = await_all(qs)
        watch.settle(qs)
    finally:
        spark.streams.removeListener(watch)
    if failed:
        raise RuntimeError(f"streaming metrics failed: {failed}")
    return watch


class StreamWatch(StreamingQueryListener):
    """Per query name: the rows that its watermark dropped, and the error that ended it.

    Dropped rows are those of the stateful operator: groups of a trigger that came too late."""

    def __init__(self):
        self.dropped: dict[str, int] = {}
        self.failed: dict[str, str] = {}
        self._names: dict[str, str] = {}
        self._ended: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        with self._lock:
            self._names[str(event.runId)] = event.name

    def onQueryProgress(self, event):
        p = event.progress
        with self._lock:
            self.dropped[p.name] = self.dropped.get(p.name, 0) + sum(
                o.numRowsDroppedByWatermark for o in p.stateOperators)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        with self._lock:
            run = str(event.runId)
            if event.exception:
                self.failed[self._names.get(run, run)] = event.exception
            self._ended.add(run)

    def settle(self, queries: list[StreamingQuery], seconds: float = 60) -> None:
        """Wait until the end of every query has been reported (events come asynchronously)."""
        until = time.time() + seconds
        while {str(q.runId) for q in queries} - self._ended:
            if time.time() > until:
                raise TimeoutError("a query's end was not reported")
            time.sleep(0.05)


def await_all(queries: list[StreamingQuery], poll: float = 0.5) -> dict[str, str]:
    """Wait for all ``queries`` together. When one fails, the others process what is available
    and stop; returns {query name: error} of those that failed."""
    failed: dict[str, str] = {}
    left = list(queries)
    while left:
        for q in list(left):
            if not q.isActive:
                left.remove(q)
                if q.exception():
                    failed[q.name] = str(q.exception())
        if failed and left:
            for q in left:
                try:
                    stop_metrics([q])
                except Exception as e:  # a second failure is reported, too
                    failed[q.name] = str(e)
            left = [q for q in left if q.isActive]
        elif left:
            try:
                left[0].awaitTermination(poll)
            except StreamingQueryException:
                pass        # told by its exception() in the next round
    return failed


def stop_metrics(queries: list[StreamingQuery], drain: bool = True) -> None:
    """Graceful stop: optionally process what is already available, then stop
    each query. Progress is in each query's checkpoint, so a restart with the
    same checkpoint root continues where this stopped."""
    for q in queries:
        if q.isActive and drain:
            q.processAllAvailable()
        q.stop()
