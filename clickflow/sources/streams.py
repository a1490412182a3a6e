"""Event stream sources, message decode and keyed publish.

The broker source (``format("kafka")``) needs the Kafka connector on the
classpath; format and options are parameters, so the same code reads a file
source with the broker's ``value`` / ``timestamp`` columns in tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.functions.timefns import parse_time, wall_clock_as_utc_instant
from clickflow.sources.schemas import ARCHIVED_EVENT, EVENT_MESSAGE

TOPIC = "user-events"
# Columns a broker source exposes that the decode step uses.
MESSAGE_COLUMNS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
])
JSON_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def kafka_options(bootstrap: str, topic: str = TOPIC, starting: str = "latest") -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting, "failOnDataLoss": "false"}


def event_stream(spark: SparkSession, fmt: str = "kafka", options: dict | None = None,
                 path: str | None = None, schema: T.StructType = MESSAGE_COLUMNS) -> DataFrame:
    """Streaming DataFrame of raw messages (``value``, ``timestamp``, ...).

    For a file source the message schema is given explicitly (no inference).
    """
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def log_slice(spark: SparkSession, start_ms: int, end_ms: int, fmt: str = "kafka",
              options: dict | None = None, path: str | None = None) -> DataFrame:
    """Batch read of the message log for ``start_ms <= broker ts < end_ms``.

    On a broker, ``startingTimestamp`` / ``endingTimestamp`` bound the offsets
    read per partition; the exact half-open filter is applied after, on the
    executors (no driver-side consumer loop).
    """
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingTimestamp", str(start_ms))
        opts.setdefault("endingTimestamp", str(end_ms))
        df = spark.read.format(fmt).options(**opts).load()
    else:
        df = spark.read.format(fmt).options(**opts).schema(MESSAGE_COLUMNS).load(path)
    ms = F.unix_millis(F.col("timestamp"))
    return df.filter((ms >= F.lit(start_ms)) & (ms < F.lit(end_ms)))


def decode(messages: DataFrame, schema: T.StructType = EVENT_MESSAGE) -> DataFrame:
    """JSON ``value`` -> typed event columns + ``kafka_timestamp``.

    A malformed document gives all-NULL fields; a field of the wrong type
    gives NULL for that field only.
    """
    return (messages.select(F.from_json(F.col("value").cast("string"), schema).alias("data"),
                            F.col("timestamp").alias("kafka_timestamp"))
                    .select("data.*", "kafka_timestamp"))


def decode_archived(messages: DataFrame) -> DataFrame:
    """Messages -> the archive row (event fields + broker ms + partition)."""
    fields = EVENT_MESSAGE
    part = F.col("partition") if "partition" in messages.columns else F.lit(None)
    return (messages.select(F.from_json(F.col("value").cast("string"), fields).alias("data"),
                            F.unix_millis(F.col("timestamp")).alias("kafka_timestamp"),
                            part.cast("bigint").alias("kafka_partition"))
                    .select("data.*", "kafka_timestamp", "kafka_partition")
                    .select([f.name for f in ARCHIVED_EVENT.fields]))


def with_event_timestamp(events: DataFrame, col: str = "event_time",
                         out: str = "event_timestamp") -> DataFrame:
    """Parsed event time as TIMESTAMP (watermarks need a zoned timestamp).
    The cast uses the session zone and the sink casts window bounds back to
    wall-clock NTZ, so stored windows are the same in any session zone with
    whole-minute offsets."""
    return events.withColumn(out, parse_time(F.col(col)).cast("timestamp"))


def _time_str(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def to_messages(events: DataFrame, broker_time: str | None = "event_time") -> DataFrame:
    """Commerce events -> keyed JSON messages (``key``, ``value``,
    ``timestamp``): key = user id as string (NULL when no user); value = the
    event message; timestamp = broker time (defaults to the event time read
    as UTC, i.e. a replay paced at event time, whatever the session zone)."""
    et = F.col("event_time")
    body = F.struct(
        _time_str(et).alias("event_time"), F.col("event_type"),
        F.col("product_id"), F.col("category_code").alias("category_id"),
        F.col("category_code"), F.col("brand"), F.col("price").cast("double").alias("price"),
        F.col("user_id"), F.lit(None).cast("string").alias("user_session"),
        _time_str(et).alias("original_time"), _time_str(et).alias("mapped_time"),
        F.lit(None).cast("string").alias("processing_time"))
    ts = wall_clock_as_utc_instant(F.col(broker_time)) if broker_time else F.current_timestamp()
    return events.select(F.col("user_id").cast("string").alias("key"),
                         F.to_json(body).alias("value"),
                         ts.alias("timestamp"),
                         F.lit(0).alias("partition"))


def publish(messages: DataFrame, bootstrap: str, topic: str = TOPIC) -> None:
    """Keyed publish to the broker (needs the Kafka connector)."""
    (messages.select("key", "value").write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def write_batches(events: DataFrame, batch: Column, path: str, files: int) -> int:
    """Write the messages of ``events`` to the folder ``path`` in the order of ``batch`` (few whole
    numbers), each batch as the same number of files, ``files`` at most; returns that number. A
    file stream with ``maxFilesPerTrigger`` set to it admits one batch per trigger."""
    tagged = events.withColumn("_batch", batch)
    sizes = {r["_batch"]: r["n"] for r in tagged.groupBy("_batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = max(1, min([files, *sizes.values()]))
    for b in sorted(sizes):
        to_messages(tagged.filter(F.col("_batch") == b)).repartition(n).write.mode("append").parquet(path)
    return n
