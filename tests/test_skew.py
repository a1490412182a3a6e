"""Hot keys: one product holds a third of all events.

With broadcasts disabled the catalogue lookup becomes a sort-merge join;
AQE must split the hot partition (skew join), and the results must equal
the broadcast plan's results.
"""

import datetime as dt

from clickflow.operators import funnel as fn
from clickflow.sources.tables import events_from_tables

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _raw(spark, n=3000):
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        k = 1 if i % 3 == 0 else 2 + i % 97            # product 1 holds a third of the rows
        et = ["view", "click", "purchase"][i % 3 if i % 7 else 1]
        rows.append((i, t0 + dt.timedelta(seconds=37 * i), i % 50, et, float(i % 100) / 4, f'{{"k": {k}}}'))
    events = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, "
                                         "event_type STRING, value DOUBLE, props STRING")
    part = spark.createDataFrame([(k, f"p{k}", f"B{k % 7}", f"T{k % 3}", 1, 1.0) for k in range(1, 100)],
                                 "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, "
                                 "p_size INT, p_retailprice DOUBLE")
    return events, part


def test_hot_product_split_by_skew_join(spark):
    events, part = _raw(spark)
    expected = sorted(map(repr, fn.funnel_by_brand(events_from_tables(events, part)).collect()))
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        ev = events_from_tables(events.repartition(8), part.repartition(4))
        joined = ev                  # full rows (ids, times, prices vary, as in real events)
        joined.collect()          # runs this query execution, so its final plan is shown
        final = spark._jvm.PythonSQLUtils.explainString(joined._jdf.queryExecution(), "formatted")
        assert "SortMergeJoin" in final
        assert "skew=true" in final, final.split("\n\n")[0]
        got = sorted(map(repr, fn.funnel_by_brand(ev).collect()))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
