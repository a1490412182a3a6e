"""Versioned, replay-safe serving store on plain Parquet.

Layout: ``<root>/metric=<m>/window_date=<d>/run_id=<r>/epoch_id=<e>/``,
columns ``row_key, created_at`` + typed metric columns. A micro-batch
overwrites exactly its own (run_id, epoch_id) partitions (dynamic partition
overwrite), so re-running an epoch after a failure leaves the store as if it
ran once. Readers see the newest version per ``row_key`` through
``latest`` (an aggregate, combined map-side per key), and keys can be
range-scanned by prefix (pushed to Parquet as min/max filters) with the
``window_date`` partition pruned from the prefix.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickflow.functions.timefns import ntz_lit, wall_clock_as_utc_instant, window_key
from clickflow.plans.joins import extreme_rows

# Row-key suffixes of the live metrics.
METRICS = ("active_users", "top_view", "purchases", "event", "brand")
NULL_KEY = "\\N"
VERSIONS = {"realtime_stats": 10, "funnel_analytics": 10,
            "personalized_recommendations": 5, "brand_performance": 10}


def row_key(metric: str) -> Column:
    """Row key of a live-metric row (rank is a column, not part of the key,
    so a product's row is overwritten in place when its rank changes)."""
    w = window_key(F.col("window_start"))

    def key(*parts):
        # a NULL part is the label NULL_KEY; backslashes and underscores inside a part are escaped, so that
        # different rows have different keys
        text = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"([\\_])", r"\\$1"), F.lit(NULL_KEY))
                for c in parts]
        return F.concat_ws("_", w, F.lit(metric), *text)

    if metric == "active_users":
        return F.concat(w, F.lit("_active_users"))
    if metric == "purchases":
        return F.concat(w, F.lit("_purchases"))
    if metric == "event":
        return key("event_type")
    if metric == "top_view":
        return key("product_id", "brand", "category_code")
    if metric == "brand":
        return key("brand", "event_type")
    raise ValueError(metric)


def metric_from_key(key: Column) -> Column:
    """Row kind from a key, first match wins (parity with key parsing)."""
    return (F.when(key.contains("active_users"), "active_users")
             .when(key.contains("purchases") & ~key.contains("event"), "purchases")
             .when(key.contains("event_view"), "event_view")
             .when(key.contains("event_cart"), "event_cart")
             .when(key.contains("event_purchase"), "event_purchase")
             .when(key.contains("brand_"), "brand")
             .when(key.contains("top_view"), "top_view"))


class VersionLog:
    """Append-only version log at ``root`` (a shared folder on a cluster)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, metric: str) -> str:
        return f"{self.root}/metric={metric}"

    def write(self, rows: DataFrame, metric: str, run_id: str, epoch_id: int,
              created_at: Column | None = None) -> None:
        """Write one epoch's rows (needs ``row_key`` and ``window_start``)."""
        out = (rows.withColumn("created_at", (created_at if created_at is not None
                                              else F.current_timestamp()).cast("timestamp_ntz"))
                   .withColumn("window_date", F.to_date(F.col("window_start")))
                   .withColumn("run_id", F.lit(run_id))
                   .withColumn("epoch_id", F.lit(int(epoch_id)).cast("bigint")))
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("window_date", "run_id", "epoch_id").parquet(self.path(metric)))

    def read(self, metric: str) -> DataFrame:
        return (self.spark.read.parquet(self.path(metric))
                .withColumn("metric", F.lit(metric)))

    def latest(self, metric: str) -> DataFrame:
        return latest(self.read(metric))

    def last_list(self, metric: str, run_id: str, epoch_id: int) -> DataFrame | None:
        """The rows of the newest list written before this epoch, those marked removed left out
        (None if there is none). The newest is found by partition columns; one epoch is read."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(metric))
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return None
        rows = self.read(metric)
        earlier = (F.col("run_id") == run_id) & (F.col("epoch_id") < epoch_id)
        last = rows.filter(earlier).agg(F.max("epoch_id")).first()[0]
        if last is not None:
            rows = rows.filter((F.col("run_id") == run_id) & (F.col("epoch_id") == last))
        else:       # a new run goes on from the newest list of the runs before
            rows = rows.filter(F.col("run_id") != run_id)
            newest = rows.agg(F.max("created_at")).first()[0]
            if newest is None:
                return None
            rows = rows.filter(F.col("created_at") == ntz_lit(newest))
        return rows.filter(~F.col("removed"))

    def scan(self, metric: str, prefix: str) -> DataFrame:
        return prefix_scan(self.read(metric), prefix)

    def compact(self, metric: str, versions: int, target_root: str) -> "VersionLog":
        """Retention job: write the newest ``versions`` versions per row key of
        ``metric`` into a new store at ``target_root`` (same layout), never
        overwriting the files being read; readers switch roots afterwards.
        Re-running overwrites the target's partitions (idempotent)."""
        kept = retain(self.read(metric).drop("metric"), versions)
        target = VersionLog(self.spark, target_root)
        (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("window_date", "run_id", "epoch_id").parquet(target.path(metric)))
        return target


#: Room for epoch numbers below the microseconds of a version's order.
EPOCH_ROOM = 10 ** 12


def version_order() -> Column:
    """(created_at, epoch_id) as one exact number."""
    micros = F.unix_micros(wall_clock_as_utc_instant(F.col("created_at"))).cast("decimal(20,0)")
    return (micros * F.lit(EPOCH_ROOM).cast("decimal(13,0)") + F.col("epoch_id")).cast("decimal(38,0)")


def latest(versions: DataFrame, key: str = "row_key") -> DataFrame:
    """Newest version per key by (created_at, epoch_id); a key whose newest version is
    marked ``removed`` is gone."""
    rows = extreme_rows(versions, [key], version_order())
    return rows.filter(~F.coalesce("removed", F.lit(False))).drop("removed") if "removed" in rows.columns else rows


def retain(versions: DataFrame, n: int, key: str = "row_key") -> DataFrame:
    """Keep the newest ``n`` versions per key (compaction input)."""
    w = Window.partitionBy(key).orderBy(F.col("created_at").desc(), F.col("epoch_id").desc())
    return versions.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def prefix_scan(df: DataFrame, prefix: str, key: str = "row_key") -> DataFrame:
    """Rows whose key starts with ``prefix`` (pushed to Parquet as StringStartsWith);
    a prefix that begins with a real ``yyyyMMdd`` date also prunes ``window_date``."""
    out = df.filter(F.col(key).startswith(prefix))
    if "window_date" in df.columns:
        try:
            day = dt.datetime.strptime(prefix[:8], "%Y%m%d").date() if len(prefix) >= 8 else None
        except ValueError:
            day = None
        if day is not None:
            out = out.filter(F.col("window_date") == F.lit(day))
    return out


def latest_by(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row per ``keys`` by ``order`` (e.g. latest snapshot of a product across windows)."""
    return extreme_rows(df, keys, F.col(order))


def write_run(rows: DataFrame, path: str, run_id: str) -> None:
    """Batch serving table (funnel, recommendation or brand records): one
    ``run_id`` partition per job run, replaced as a whole when the run is
    repeated; older runs stay for the version history."""
    (rows.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path))


def latest_run(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest run (run ids are ``yyyyMMdd_HHmmss`` strings)."""
    df = spark.read.parquet(path)
    newest = df.agg(F.max("run_id")).scalar()
    return df.filter(F.col("run_id") == newest)
