"""Results do not depend on the session time zone (batch times are
TIMESTAMP_NTZ; literals and epoch conversions are zone-free)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

import __spark_entry__ as E
from clickflow.functions.timefns import ntz_lit, utc_wall_clock, wall_clock_as_utc_instant
from oracle_check import compare, duck


@pytest.fixture()
def new_york(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", old)


def test_conversions_are_zone_free(new_york):
    spark = new_york
    row = spark.range(1).select(
        ntz_lit(dt.datetime(2024, 1, 30, 12, 0, 1, 250000)).alias("t"),
        F.unix_millis(wall_clock_as_utc_instant(ntz_lit("2024-01-30 12:00:01.250"))).alias("ms"),
        utc_wall_clock(F.lit(1706616001250)).alias("back")).first()
    assert row.t == dt.datetime(2024, 1, 30, 12, 0, 1, 250000)
    assert row.ms == 1706616001250
    assert row.back == dt.datetime(2024, 1, 30, 12, 0, 1, 250000)


@pytest.mark.parametrize("name", ["funnel_union", "recs_wide", "funnel_lookback", "recent_purchases"])
def test_queries_match_oracle_in_other_zone(new_york, name):
    r = compare(new_york, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r


def test_log_times_are_parsed_as_written(new_york):
    from clickflow.functions.timefns import parse_time
    texts = {"2019-12-01 01:02:03 UTC": dt.datetime(2019, 12, 1, 1, 2, 3), " 2019-12-01T01:02:03.5 ": dt.datetime(2019, 12, 1, 1, 2, 3, 500000),
             "2019-12-01 01:02:03+02:00": dt.datetime(2019, 12, 1, 1, 2, 3), "2019-13-01 00:00:00": None, "12:30:00": None, "": None, "bad": None}
    df = new_york.createDataFrame([(t,) for t in texts] + [(None,)], "t STRING")
    assert {r.t: r.p for r in df.select("t", parse_time(F.col("t")).alias("p")).collect()} == {**texts, None: None}


@pytest.mark.parametrize("name", ["sliding_active_users", "sliding_purchases"])
def test_windows_by_differences_in_other_zone(new_york, name):
    r = compare(new_york, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck(SF_SMALL))
    assert r["ok"], r
