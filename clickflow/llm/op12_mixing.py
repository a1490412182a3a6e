"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target: its share by weight of all words, at most ``max_repeat``
times its own words, the excess shared again by weight among the others until none is
above. A source's target over its words is the copies expected of each of its documents;
the whole part is allocated to all of them as certain copies, and the rest is the
inclusion probability of one more.

The extra copies are drawn by Pareto order sampling: document i with inclusion
probability p and a uniform u fixed by its content ranks by ``(u / (1 - u)) / (p / (1 - p))``,
and the n smallest ranks are taken, which is a sample of fixed size. A source's documents
are ranked within classes of nearly equal size (the length of the size in bits and its
first four bits): the classes' sample sizes follow from their counts, from the longest
class to the shortest, each rounding passed on in words to the next class. So p differs
by source and class, long documents can't upset the total, and the words taken come
within about the shortest documents' size of the target, up to the few percent by which
sizes differ in a class.

Ranks within a hot source come from one range sort of the candidates; weights are numbered
by the same means, and only scalars of the sharing rounds reach the driver.

Defined results: a null text has size 0 and is taken 0 times; a null source is a source
of its own, the last one; repeated rows are documents of their own, and rows that tie in
all columns are interchangeable; an empty table gives no rows; a source without words has
target 0; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, written

WEIGHTS, MAX_REPEAT, SEED = (1, 2, 3), 3, "mix"
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target of every source of ``sizes`` (source, size).

    ``weights`` repeat over the sources by code point, null last."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = numbered(sources, [F.col("source").isNull(), F.col("source")], "mix-sources", "place")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights)).cast("int") + 1)
    sources = written(sources.select("source", "source_size", weight.alias("weight"),
                                     (F.col("source_size") * max_repeat).alias("most")), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    # each round settles the sources at their most; all sums are of integers, so no order shows
    over, share, by = None, total, None
    while True:
        free = sources if over is None else sources.where(~over)
        used = sources.where(over).agg(F.sum("most")).first()[0] if over is not None else 0
        share, by = total - (used or 0), free.agg(F.sum("weight")).first()[0]
        if by is None:
            break
        wide = "decimal(38,0)"
        now = F.col("most").cast(wide) * F.lit(by) < F.col("weight").cast(wide) * F.lit(share)
        if not free.where(now).limit(1).count():
            break
        over = now if over is None else (over | now)
    target = F.col("most").cast("double")
    if by is not None:
        fair = F.col("weight") * F.lit(share).cast("double") / F.lit(by).cast("double")
        target = fair if over is None else F.when(over, target).otherwise(fair)
    return sources.select("source", "source_size", target.alias("target"))


def size_class(size: Column) -> Column:
    """Sizes of one class differ by an eighth at most: bits of the size, and its first four."""
    bits = F.bin(size)
    return (F.length(bits) * 16 + F.conv(F.substring(bits, 1, 4), 2, 10).cast("int")).cast("int")


def sample_sizes(classes: DataFrame) -> DataFrame:
    """source, class, n, chosen of the size classes ``classes`` (source, class, n, words, rest): ``rest`` is
    the source's probability of one more copy, ``chosen`` the number of documents that get it."""
    item = F.struct((-F.col("class")).alias("order"), "class", "n", "words", "rest")
    # some 60 * 8 classes at most, whatever the source holds
    steps = F.aggregate(
        F.sort_array(F.collect_list(item)),
        F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<struct<class: int, n: bigint, chosen: bigint>>").alias("out")),
        lambda acc, x: _step(acc, x))
    out = classes.groupBy("source").agg(steps["out"].alias("out"))
    return out.select("source", F.inline("out"))


def _step(acc: Column, x: Column) -> Column:
    want = x["rest"] * x["words"] + acc["carry"]
    mean = x["words"].cast("double") / x["n"]
    chosen = F.least(F.greatest(F.floor(want / mean + 0.5), F.lit(0).cast("long")), x["n"])
    return F.struct((want - chosen * mean).alias("carry"), F.concat(acc["out"], F.array(F.struct(
        x["class"].alias("class"), x["n"].alias("n"), chosen.alias("chosen")))).alias("out"))


def uniform(seed: str = SEED) -> Column:
    """A number in (0, 1) fixed by the row's doc_id and text; 52 bits of a digest."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "digest")
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def mix(docs: DataFrame, weights: tuple = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every row of ``docs`` (doc_id, text, source)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.md5(text).alias("digest"))
    base = written(base.withColumn("u", uniform(seed)), "mix")  # texts are read once
    targets = written(source_targets(base, weights, max_repeat), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.floor(copies)).withColumn("rest", copies - F.floor(copies))
    same = F.col("source").eqNullSafe(F.col("t_source"))
    keyed = targets.withColumnRenamed("source", "t_source")
    rows = base.join(keyed, same, "left").drop("t_source").withColumn("class", F.when(F.col("size") > 0, size_class(F.col("size"))))
    classes = rows.where("class IS NOT NULL AND rest > 0").groupBy("source", "class").agg(
        F.count("*").alias("n"), F.sum("size").alias("words"), F.first("rest").alias("rest"))
    chosen = sample_sizes(classes).select(F.col("source").alias("c_source"), F.col("class").alias("c_class"), "n", "chosen")
    rows = rows.join(chosen, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("class") == F.col("c_class")), "left")
    p = F.col("chosen") / F.col("n")
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    drawn = (F.col("chosen") > 0) & (F.col("chosen") < F.col("n"))
    rows = written(rows.withColumn("rank", F.when(drawn, rank)).drop("c_source", "c_class"), "mix-ranks")
    ranked = numbered(rows.where("rank IS NOT NULL"), [F.col(c) for c in ("source", "class", "rank", "doc_id", "digest")],
                      "mix-order")
    first = ranked.groupBy("source", "class").agg(F.min("at").alias("first")).select(
        F.col("source").alias("f_source"), F.col("class").alias("f_class"), "first")
    ranked = ranked.join(first, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("class") == F.col("f_class")))
    extra = (F.col("at") - F.col("first") < F.col("chosen")).cast("long")
    sure = (F.col("chosen") == F.col("n")).cast("long")
    columns = ["doc_id", "source", "size", "source_size", "target", "whole"]
    out = ranked.select(*columns, extra.alias("extra")).unionByName(
        rows.where("rank IS NULL").select(*columns, F.coalesce(sure, F.lit(0)).cast("long").alias("extra")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("extra")).otherwise(0).cast("long")
    return out.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))
