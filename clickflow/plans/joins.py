"""Helpers for dimension joins and shared intermediates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def one_per_user(users: DataFrame, *cols: str) -> DataFrame:
    """One row per user_id with the smallest (NULLs aside) of ``cols``, so a user
    listed twice is one user. Combined before the shuffle."""
    return users.groupBy("user_id").agg(*[F.min(c).alias(c) for c in cols])


def extreme_rows(df: DataFrame, keys: list[str], order: Column, newest: bool = True) -> DataFrame:
    """The row of each key with the greatest (else least) ``order``, a number or a time; of
    rows that tie, the one that sorts first by its columns. NULL is a key; rows without
    ``order`` don't count.

    The extreme is a hash aggregate, combined before the shuffle; its few rows then select
    the winners by (key, order), and only those are numbered."""
    tagged = df.withColumn("_order", order)
    best = tagged.groupBy(*keys).agg((F.max if newest else F.min)("_order").alias("_best")).dropna(subset=["_best"])
    best = best.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], "_best")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    won = tagged.join(best, same & (F.col("_order") == F.col("_best")), "left_semi").drop("_order")
    w = Window.partitionBy(*keys).orderBy(*[c for c in df.columns if c not in keys] or keys)
    return won.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") == 1).drop("_place")


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate that more than one branch reads (e.g. the brand
    metrics that both yield a top-N list and are filtered by it) once as
    Parquet into the session's shared scratch folder and read it back: it is
    computed once, its lineage is cut, and each branch reads only its columns.
    Eager, since both branches follow immediately."""
    from clickflow.session import scratch_path
    path = scratch_path(df.sparkSession, "shared")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
