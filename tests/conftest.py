import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

EVENT_DDL = ("event_id BIGINT, event_time TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
             "product_id BIGINT, category_code STRING, brand STRING, price DECIMAL(18,2)")
USER_DDL = "user_id BIGINT, name STRING, birth_date DATE, city STRING"
PRODUCT_DDL = ("product_id BIGINT, product_name STRING, category_id STRING, category_name STRING, "
               "category_code STRING, brand STRING, price DOUBLE")

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("clickflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(
            s.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="clickflow-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="clickflow-test-")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def money(x) -> Decimal:
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def make_events(spark, rows):
    """rows: (event_id, 'iso time', user_id, type, product_id, category, brand, price)."""
    data = [(r[0], ts(r[1]) if r[1] else None, r[2], r[3], r[4], r[5], r[6], money(r[7]))
            for r in rows]
    return spark.createDataFrame(data, EVENT_DDL)


def make_users(spark, rows):
    data = [(r[0], r[1], dt.date.fromisoformat(r[2]) if r[2] else None, r[3]) for r in rows]
    return spark.createDataFrame(data, USER_DDL)


def make_products(spark, rows):
    return spark.createDataFrame(rows, PRODUCT_DDL)


def by(rows, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
