"""Fixed schemas of the commerce data model (event message, archive, dims)."""

from pyspark.sql import types as T

# Event message as it travels on the stream (JSON); every field nullable.
EVENT_MESSAGE = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
    T.StructField("original_time", T.StringType()),
    T.StructField("mapped_time", T.StringType()),
    T.StructField("processing_time", T.StringType()),
])

# Archived event: message fields plus broker metadata.
ARCHIVED_EVENT = T.StructType(EVENT_MESSAGE.fields + [
    T.StructField("kafka_timestamp", T.LongType()),
    T.StructField("kafka_partition", T.LongType()),
])

ARCHIVE_PARTITIONS = ["year", "month", "day", "hour"]

# Raw monthly CSV log.
RAW_EVENT_CSV = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("user_session", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("surname", T.StringType()),
    T.StructField("birth_date", T.DateType()),
    T.StructField("city", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("street_name", T.StringType()),
    T.StructField("house_number", T.StringType()),
])

# Prepared product file (read by header name, see README on column order).
PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
])
