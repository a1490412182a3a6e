"""Host-level quality rules.

Per document: word and line statistics and two rules, ``too_short`` (fewer than
``min_words`` words) and ``repetitive`` (more than ``max_repeat`` percent of the
words lie in 8-word windows that occur twice or more in the text). Rule failures
are summed by host (the column ``source``); each rule's rate is shrunk towards
the corpus by a beta prior whose mean and strength are fitted to all hosts by
moments, so a small host is judged by few failures only as far as hosts differ
at all. A host one of whose shrunk rates exceeds ``max_host_rate`` is rejected
with all its documents; verdicts are joined back to the documents.

DataFrame operations only. Sums by host combine before the shuffle, so a hot
host costs one row per task; the join back is left to adaptive execution, which
broadcasts a host table that turned out small and splits a hot host otherwise.

Defined results: a null text has no words and fails; a null host has no verdict
and rejects nothing; repeated rows are judged and returned row by row; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import written

MIN_WORDS, MAX_REPEAT, WINDOW, MAX_HOST_RATE = 20, 30, 8, 0.5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
RULES = ("too_short", "repetitive")
#: Prior strength when hosts differ no more than chance would make them.
POOLED = 1e9


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _arr(name: str, i: Column) -> Column:
    return F.get(F.col(name), i)


def text_statistics(docs: DataFrame, *keep: Column, window: int = WINDOW) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of every row."""
    names = [f"k{i}" for i in range(len(keep))]
    df = docs.select(*[c.alias(n) for c, n in zip(keep, names)],
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    df = df.select(*names, "t", F.transform(F.array_remove(F.split("t", "[ \\t-\\r]+"), ""),
                                            lambda x: F.xxhash64(x)).alias("w"),
                   F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("lines"))
    df = df.select(*names, F.size("w").cast("long").alias("n_words"),
                   (F.length("t") - _count(F.col("t"), SPACES)).cast("long").alias("word_chars"),
                   _count(F.col("t"), SYMBOLS).alias("n_symbols"),
                   (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                   F.transform(F.slice("w", F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(0))),
                               lambda _, i: F.xxhash64(*[_arr("w", i + j) for j in range(window)])).alias("g"))
    cols = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    # windows sorted by hash, only where some window repeats at all
    df = df.select(*cols, F.when(F.size(F.array_distinct("g")) < F.size("g"), F.sort_array(F.transform(
        "g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))).alias("s"))
    n = F.size("s")
    df = df.select(*cols, "s", F.when(F.col("s").isNotNull(), F.zip_with(
        F.slice("s", F.lit(1), n - 1), F.slice("s", F.lit(2), n - 1), lambda a, b: a["x"] == b["x"])).alias("same"))
    df = df.select(*cols, F.when(F.col("s").isNotNull(), F.sort_array(F.transform(
        F.filter("s", lambda _, j: F.coalesce(_arr("same", j), F.lit(False))
                 | F.when(j > 0, F.coalesce(_arr("same", j - 1), F.lit(False))).otherwise(False)),
        lambda v: v["i"]))).alias("p"))
    # a word counts once, though several repeated windows cover it
    m = F.size("p")
    covered = F.aggregate(F.zip_with(F.slice("p", F.lit(1), m - 1), F.slice("p", F.lit(2), m - 1),
                                     lambda a, b: F.least(F.lit(window), b - a)), F.lit(window), lambda a, b: a + b)
    return df.select(*cols, F.when(F.col("p").isNotNull(), covered).otherwise(0).cast("long").alias("n_repeat_words"))


def beta_prior(hosts: DataFrame, fails: str) -> tuple[float, float]:
    """(mean, strength) of the beta prior of one rule's rate, by moments over all hosts."""
    r = hosts.agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(fails).alias("f"),
                  F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
                  F.sum(F.col(fails).cast("double") * F.col(fails) / F.col("n")).alias("ff")).first()
    if not r["n"]:
        return 0.0, POOLED
    n, mean = float(r["n"]), r["f"] / r["n"]
    between = r["ff"] - n * mean * mean  # sum over hosts of n * (rate - mean) ** 2
    room = n - r["nn"] / n
    v = (between - (r["k"] - 1) * mean * (1 - mean)) / room if room > 0 else 0.0
    return mean, max(mean * (1 - mean) / v - 1, 0.0) if v > 0 else POOLED


def host_rates(base: DataFrame) -> DataFrame:
    """host, n, and per rule its failures and shrunk rate."""
    hosts = base.where(F.col("host").isNotNull()).groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    hosts = written(hosts, "hosts")
    for r in RULES:
        mean, strength = beta_prior(hosts, r)
        hosts = hosts.withColumn(f"{r}_rate", (F.col(r) + mean * strength) / (F.col("n") + strength))
    return hosts


def judge(docs: DataFrame, min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT,
          max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source) with its statistics and verdicts."""
    base = text_statistics(docs, F.col("doc_id").cast("long"), F.col("source").cast("string"))
    base = (base.withColumnsRenamed({"k0": "doc_id", "k1": "host"})
            .withColumn("too_short", F.col("n_words") < min_words)
            .withColumn("repetitive", 100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
            .withColumn("base_failed", F.col("too_short") | F.col("repetitive")))
    base = written(base, "quality")  # a few numbers a row; texts are read once
    worst = F.greatest(*[F.col(f"{r}_rate") for r in RULES])
    hosts = host_rates(base).select("host", (worst > max_host_rate).alias("host_failed"), worst.alias("host_rate"))
    out = base.join(hosts, "host", "left")
    return out.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "host_rate",
                      (~F.col("base_failed") & ~F.coalesce("host_failed", F.lit(False))).alias("kept"))
