"""Hourly archive of the event log to partitioned Parquet, its
verification and the look-back reads over it.

The archive is partitioned by broker (archive) time, with zero-padded
``year=/month=/day=/hour=`` directories; Spark reads them back as INT
partition columns and prunes on them. Writes use dynamic partition
overwrite, so re-running an hour replaces exactly that hour (idempotent),
and ``maxRecordsPerFile`` bounds file size instead of driver-side batching.

Broker time says little about event time: messages come late, and clocks run
ahead. Look-backs by event time therefore go through a zone map, the least and
greatest event time of every archive hour, kept below ``_zones`` (which Spark's
partition discovery skips). An hour is *open*, bounded by all of time and so never
pruned, from before its files change until its new bounds are known.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.timefns import ntz_lit, parse_time, partition_date_range, utc_wall_clock
from clickflow.sources.schemas import ARCHIVE_PARTITIONS
from clickflow.sources.streams import decode_archived

ROWS_PER_FILE = 250_000


def _ms(t: dt.datetime) -> int:
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)


def with_archive_partitions(rows: DataFrame, ms_col: str = "kafka_timestamp") -> DataFrame:
    """year/month/day/hour (zero-padded strings) of the broker time in UTC
    (independent of the session time zone)."""
    ts = utc_wall_clock(F.col(ms_col))
    return rows.select("*",
                       F.year(ts).cast("string").alias("year"),
                       F.lpad(F.month(ts).cast("string"), 2, "0").alias("month"),
                       F.lpad(F.dayofmonth(ts).cast("string"), 2, "0").alias("day"),
                       F.lpad(F.hour(ts).cast("string"), 2, "0").alias("hour"))


# --- zone map -------------------------------------------------------------------

ZONE_TIME = "mapped_time"     # the event time that the zone map bounds
ZONE_SCHEMA = T.StructType([
    *[T.StructField(c, T.IntegerType()) for c in ARCHIVE_PARTITIONS],
    T.StructField("stamp", T.LongType()), T.StructField("open", T.BooleanType()),
    T.StructField("rows", T.LongType()),
    T.StructField("low", T.TimestampNTZType()), T.StructField("high", T.TimestampNTZType())])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _has_hours(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/year=*")
    return len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []) > 0


def _zone_path(path: str) -> str:
    return f"{path.rstrip('/')}/_zones"


def hour_zones(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest zone of every archive hour, or None for an archive without a zone map.

    The map is a log of one row per hour and write; its size follows the archive's
    length in hours, not its rows."""
    if not _exists(spark, _zone_path(path)):
        return None
    log = spark.read.schema(ZONE_SCHEMA).parquet(_zone_path(path))
    newest = log.groupBy(*ARCHIVE_PARTITIONS).agg(F.max("stamp").alias("stamp"))
    return log.join(newest, [*ARCHIVE_PARTITIONS, "stamp"])


def _next_stamp(spark: SparkSession, path: str) -> int:
    if not _exists(spark, _zone_path(path)):
        return 1
    return (spark.read.schema(ZONE_SCHEMA).parquet(_zone_path(path)).agg(F.max("stamp")).first()[0] or 0) + 1


def _add_zones(zones: DataFrame, path: str) -> None:
    (zones.select([F.col(f.name).cast(f.dataType) for f in ZONE_SCHEMA.fields])
     .coalesce(1).write.mode("append").parquet(_zone_path(path)))


def _open_hours(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime, stamp: int) -> None:
    """Mark every hour of [start, end) as open."""
    first = start.replace(minute=0, second=0, microsecond=0)
    hours = max(0, -int((first - end).total_seconds() // 3600))
    at = ntz_lit(first) + F.make_dt_interval(F.lit(0), F.col("id"), F.lit(0))
    zones = spark.range(hours).select(
        F.year(at).alias("year"), F.month(at).alias("month"), F.dayofmonth(at).alias("day"), F.hour(at).alias("hour"),
        F.lit(stamp).alias("stamp"), F.lit(True).alias("open"), F.lit(None).alias("rows"),
        ntz_lit(dt.datetime.min).alias("low"), ntz_lit(dt.datetime.max).alias("high"))
    _add_zones(zones, path)


def _bounds(rows: DataFrame, stamp: int) -> DataFrame:
    t = parse_time(F.col(ZONE_TIME))
    return rows.groupBy(*ARCHIVE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("rows"), F.min(t).alias("low"), F.max(t).alias("high")).withColumns(
        {"stamp": F.lit(stamp), "open": F.lit(False)})


def index_hours(spark: SparkSession, path: str) -> None:
    """Build the zone map of an archive that has none (one scan of one column)."""
    _add_zones(_bounds(spark.read.parquet(path), _next_stamp(spark, path)), path)


# --- writing --------------------------------------------------------------------

def _hours_between(df: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """The rows of ``df`` in archive hours of [start, end), by partition columns."""
    at = F.make_timestamp_ntz(F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0))
    first = start.replace(minute=0, second=0, microsecond=0)
    return df.filter(partition_date_range(start, end)).filter((at >= ntz_lit(first)) & (at < ntz_lit(end)))


def _delete_hours(spark: SparkSession, path: str, hours) -> None:
    for r in hours:
        p = spark._jvm.org.apache.hadoop.fs.Path(
            f"{path}/year={r['year']}/month={r['month']:02d}/day={r['day']:02d}/hour={r['hour']:02d}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def archive_hours(messages: DataFrame, start: dt.datetime, end: dt.datetime, path: str,
                  rows_per_file: int = ROWS_PER_FILE) -> int:
    """Archive messages with ``start <= broker time < end`` (UTC, whole hours)
    into hourly partitions below ``path``; returns the number of rows written
    (counted while writing, no second pass).

    The hours of the range are replaced: those with messages by the write itself
    (a failed write leaves the old ones), those that hold none any more are deleted
    after it. Rows are gathered by hour before the write (``rebalance``: small hours
    share a task, a hot hour is split), so the files follow the hours and not
    tasks times hours. The zone map is brought up to date from the files written."""
    spark = messages.sparkSession
    lo, hi = _ms(start), _ms(end)
    rows = decode_archived(messages).filter(
        (F.col("kafka_timestamp") >= lo) & (F.col("kafka_timestamp") < hi))
    obs = Observation("archive")
    out = (with_archive_partitions(rows).hint("rebalance", *ARCHIVE_PARTITIONS)
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    old = _has_hours(spark, path)
    if old and not _exists(spark, _zone_path(path)):
        index_hours(spark, path)
    stamp = _next_stamp(spark, path)
    _open_hours(spark, path, start, end, stamp)
    before = (_hours_between(spark.read.parquet(path), start, end).select(*ARCHIVE_PARTITIONS).distinct().collect()
              if old else [])     # at most one row per hour of the range
    (out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .option("compression", "snappy")
        .partitionBy(*ARCHIVE_PARTITIONS)
        .parquet(path))
    written = int(obs.get.get("rows", 0))
    if before:
        held = {tuple(map(int, r)) for r in
                with_archive_partitions(rows).select(*ARCHIVE_PARTITIONS).distinct().collect()}
        _delete_hours(spark, path, [r for r in before if tuple(r) not in held])
    if written:
        _add_zones(_bounds(_hours_between(spark.read.parquet(path), start, end), stamp + 1), path)
    return written


def verify_archive(spark: SparkSession, path: str) -> DataFrame:
    """Per partition: rows, Parquet file count and bytes, from the hidden
    ``_metadata`` column (no listing on the driver)."""
    df = spark.read.parquet(path).select(*ARCHIVE_PARTITIONS, "_metadata.file_path",
                                         "_metadata.file_size")
    per_file = df.groupBy(*ARCHIVE_PARTITIONS, "file_path", "file_size").agg(
        F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(*ARCHIVE_PARTITIONS).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"),
        F.sum("file_size").alias("bytes"))


def read_window(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime,
                ts_col: str = "kafka_timestamp") -> DataFrame:
    """Rows with ``start <= broker time < end``: a partition predicate built
    from a date range (correct across month ends) prunes directories, then
    the exact time filter applies."""
    df = spark.read.parquet(path)
    return (df.filter(partition_date_range(start, end))
              .filter((F.col(ts_col) >= _ms(start)) & (F.col(ts_col) < _ms(end))))


def read_event_time(spark: SparkSession, path: str, start: dt.datetime, end: dt.datetime | None = None,
                    ts_col: str = ZONE_TIME) -> DataFrame:
    """Rows with ``start <= event time`` (``<= end`` if given); ``event_timestamp`` is added.

    Archive hours whose event times lie outside, by the zone map, are pruned (a semi
    join on the partition columns: the filtered zones, one row per hour and so bounded
    by the archive's length, are broadcast and prune directories at run time). Early
    and late messages are found wherever they were archived. Without a zone map, or by
    another time column, every hour is read."""
    rows = spark.read.parquet(path)
    zones = hour_zones(spark, path) if ts_col == ZONE_TIME else None
    if zones is not None:
        inside = F.col("high") >= ntz_lit(start)
        if end is not None:
            inside = inside & (F.col("low") <= ntz_lit(end))
        rows = rows.join(F.broadcast(zones.filter(inside).select(*ARCHIVE_PARTITIONS)),
                         list(ARCHIVE_PARTITIONS), "left_semi")
    ts = F.col("event_timestamp")
    rows = rows.withColumn("event_timestamp", parse_time(F.col(ts_col))).filter(ts >= ntz_lit(start))
    return rows if end is None else rows.filter(ts <= ntz_lit(end))
