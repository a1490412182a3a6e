"""Time expressions: parsing, look-backs, hour slices, keys, replay remap.

All look-back helpers take an explicit ``as_of`` instead of reading the
clock, so a run is reproducible and back-fillable.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats of the serving keys and report labels.
WINDOW_KEY_FORMAT = "yyyyMMdd_HHmm"
WINDOW_LABEL_FORMAT = "HH:mm dd.MM.yyyy"
RUN_KEY_FORMAT = "yyyyMMdd_HHmmss"


def ntz_lit(x) -> Column:
    """A TIMESTAMP_NTZ literal from a naive datetime, date or ISO string.

    Built from text, so it does not depend on the session or the Python
    process time zone (a Python datetime literal would be a zoned TIMESTAMP).
    """
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        x = dt.datetime.fromisoformat(x)
    if isinstance(x, dt.date) and not isinstance(x, dt.datetime):
        x = dt.datetime(x.year, x.month, x.day)
    return F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz")


_ts = ntz_lit


def wall_clock_as_utc_instant(ntz: Column) -> Column:
    """TIMESTAMP_NTZ wall clock -> the TIMESTAMP instant of that wall clock in
    UTC, independent of the session time zone (epoch seconds of an NTZ value
    are zone-free, and so is its micro-second field)."""
    micros = (F.unix_timestamp(ntz).cast("long") * F.lit(1000000)
              + F.date_format(ntz, "SSSSSS").cast("long"))
    return F.timestamp_micros(micros)


def utc_wall_clock(epoch_ms: Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ wall clock in UTC, independent of
    the session time zone."""
    secs = (epoch_ms.cast("decimal(20,3)") / F.lit(1000)).cast("decimal(18,6)")
    return ntz_lit(dt.datetime(1970, 1, 1)) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def parse_time(c: Column) -> Column:
    """String to TIMESTAMP_NTZ in one parse; bad input gives NULL instead of raising.

    Accepts the ``yyyy-MM-dd HH:mm:ss UTC`` log form and ISO ``T`` forms. The wall clock as
    written counts, whatever zone stands behind it and whatever the session's zone is."""
    return F.trim(c).try_cast("timestamp_ntz")


def between_closed(ts: Column, as_of, hours: float = 24) -> Column:
    """as_of - hours <= ts <= as_of (the funnel look-back)."""
    end = _ts(as_of)
    return ts.between(end - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0)), end)


def since(ts: Column, as_of, hours: float | None = None, days: float | None = None) -> Column:
    """ts >= as_of - interval (lower bound only, open-ended above)."""
    secs = (hours or 0) * 3600.0 + (days or 0) * 86400.0
    return ts >= _ts(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(secs))


def hour_slice(ts: Column, start, end) -> Column:
    """Half-open slice start <= ts < end."""
    return (ts >= _ts(start)) & (ts < _ts(end))


def events_between(events: DataFrame, as_of, hours: float = 24, ts: str = "event_time") -> DataFrame:
    return events.filter(between_closed(F.col(ts), as_of, hours))


def events_since(events: DataFrame, as_of, days: float = 1, ts: str = "event_time") -> DataFrame:
    return events.filter(since(F.col(ts), as_of, days=days))


def window_key(ts: Column) -> Column:
    """``yyyyMMdd_HHmm`` serving key prefix of a window start."""
    return F.date_format(ts, WINDOW_KEY_FORMAT)


def key_to_time(key: Column) -> Column:
    return F.to_timestamp_ntz(F.substring(key, 1, 13), F.lit(WINDOW_KEY_FORMAT))


def key_label(key: Column) -> Column:
    """``20191230_1600`` -> ``16:00 30.12.2019``."""
    return F.date_format(key_to_time(key), WINDOW_LABEL_FORMAT)


def window_keys(spark, start: str, end: str, minutes: int = 5) -> DataFrame:
    """All keys from start to end inclusive every ``minutes`` (one row each).

    Generated by a distributed range (the key count follows from the two
    parameters), not by exploding one row, so a long range is not built in
    a single task."""
    t0 = dt.datetime.strptime(start, "%Y%m%d_%H%M")
    t1 = dt.datetime.strptime(end, "%Y%m%d_%H%M")
    n = int((t1 - t0).total_seconds() // (60 * minutes)) + 1 if t1 >= t0 else 0
    ws = ntz_lit(t0) + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id") * F.lit(minutes))
    return (spark.range(n).select(ws.alias("window_start"))
            .select(window_key(F.col("window_start")).alias("window_key"), "window_start"))


def remap_replay_time(ts: Column, target_year: int, split_day: int = 27) -> Column:
    """Replay remap of a December log: days >= split_day stay in December of
    ``target_year``; earlier days move to January of ``target_year + 1``.
    Time of day is kept."""
    day = F.dayofmonth(ts)
    year = F.when(day >= split_day, F.lit(target_year)).otherwise(F.lit(target_year + 1))
    month = F.when(day >= split_day, F.lit(12)).otherwise(F.lit(1))
    time_of_day = ts - F.date_trunc("day", ts).cast("timestamp_ntz")
    return F.make_date(year, month, day).cast("timestamp_ntz") + time_of_day


def partition_date_range(start, end) -> Column:
    """Predicate on year/month/day partition columns covering [start, end];
    correct across month and year ends (a date built from the parts is
    compared, and Spark still prunes on the partition columns)."""
    d = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    s = _ts(start).cast("date")
    e = _ts(end).cast("date")
    return d.between(s, e)
