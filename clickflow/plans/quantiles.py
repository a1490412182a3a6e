"""Exact quantiles by rank selection: no task holds all values.

Equal values are counted first (combined before the shuffle), the counted values are
dealt by ranges, and the counts before each range are one number a partition. A quantile
is then the value whose places hold its rank, found by one aggregate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickflow.plans.joins import materialize


#: Distinct values up to which the counted values themselves are read.
FEW = 4096


def placed_values(df: DataFrame, col: str) -> DataFrame:
    """value, n, before: the distinct values of ``col`` (NULL left out), how often each occurs
    and how many are smaller."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # written once: both passes must see the same ranges
    ranges = materialize(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("part").agg(F.sum("n").alias("size")).select(
        "part", F.coalesce(F.sum("size").over(whole), F.lit(0)).alias("offset"))    # one row per partition
    inside = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.join(F.broadcast(parts), "part").select(
        "value", "n", (F.col("offset") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("before"))


def exact_quantiles(df: DataFrame, col: str, quantiles: list[float]) -> dict[float, float | None]:
    """The linearly interpolated quantiles of ``col`` (None without values): a handful of
    numbers reach the driver."""
    counts = (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("value"))
              .agg(F.count(F.lit(1)).alias("n")))
    few = counts.limit(FEW + 1).collect()
    if len(few) <= FEW:     # a bounded list of values: the same selection without a range pass
        few = sorted((r["value"], r["n"]) for r in few)
        return _selected(quantiles, sum(n for _, n in few), lambda ranks: _walk(few, ranks))
    values = placed_values(df, col)
    n = values.agg(F.sum("n")).first()[0]

    def select(ranks: list[int]) -> dict[int, float]:
        row = values.agg(*[at(r).cast("double").alias(str(r)) for r in ranks]).first()
        return {r: row[str(r)] for r in ranks}

    def at(rank: int) -> Column:
        held = (F.col("before") <= rank) & (F.col("before") + F.col("n") > rank)
        return F.max(F.when(held, F.col("value")))

    return _selected(quantiles, n, select)


def _walk(values: list[tuple[float, int]], ranks: list[int]) -> dict[int, float]:
    out, end, left = {}, 0, list(ranks)
    for value, n in values:
        end += n
        while left and left[0] < end:
            out[left.pop(0)] = value
    return out


def _selected(quantiles: list[float], n: int, select) -> dict[float, float | None]:
    if not n:
        return {q: None for q in quantiles}
    places = {q: (n - 1) * q for q in quantiles}
    ranks = sorted({r for p in places.values() for r in (math.floor(p), math.ceil(p))})
    row = select(ranks)
    out = {}
    for q, p in places.items():
        lo, hi = math.floor(p), math.ceil(p)
        a, b = row[lo], row[hi]
        out[q] = a if lo == hi or a == b else (hi - p) * a + (p - lo) * b
    return out
