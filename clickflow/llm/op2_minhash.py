"""Near-duplicate components by bottom-k sketches of one hash function.

A document's set is that of its distinct ``width``-word shingles (whole text,
A-Z lower-cased); its sketch keeps the ``k`` smallest hash values. Documents with
the same set are one class, and all further work is on classes.

1. Inverted lists of retained values. Two sets of similarity t or more share at
   least ``least_shared`` of their retained values (five standard deviations below
   the expectation, so the chance of less is about one in a million), hence also
   one of each one's ``k - least_shared + 1`` rarest. Only those are indexed: a
   passage that stands in many unlike documents gives long lists that no one
   enters unless most of its sketch consists of such values.
2. Pairs from the lists. Each member is paired with its list's centre, the member
   whose values are shared most: a number of pairs in proportion to the lists'
   length, which joins the members of a group of copies to few components.
3. The k smallest values of the union of both sketches estimate the similarity to
   the centre; members whose estimate lies five standard deviations below 2t - 1,
   or whose size alone rules 2t - 1 out, count as unlike the centre.
4. The rest is verified on full sets, recomputed from the whole texts.
5. Members that belong to other components than their list's centre may still be
   linked with one another. 1 - similarity is a metric, so a member less than
   2t - 1 similar to the centre (unlike) has no link to one that is t or more
   similar to it. Hence members of 2t - 1 or more are compared within the centre's
   group (not the members joined to the centre among themselves), and unlike
   members with the members of their list below t, in blocks of ``BLOCK`` full
   sets: a block pair is one matrix product of set incidences, and returns no more
   links than it has components to join. No row is made for a pair of members.

Defined results: a null, empty or wordless text has n_shingles 0 and is linked
with nothing; a row without doc_id is linked with nothing (component_id null,
kept); rows that repeat a doc_id are one document with the links of all its texts: they
share its component and are returned as often as they occur; long texts are whole, one text being held at a time with its set; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, Window

from .common import chunks, give_back, lists, mix, shingles, utf8, words, written
from .graph import components

K, WIDTH, PERCENT, BLOCK = 32, 3, 85, 512


def least_shared(m: int, t: float) -> int:
    """Retained values that two sets of similarity t share at least, if a sketch has m values."""
    return max(1, math.floor(t * m - 5 * math.sqrt(m * t * (1 - t))))


def shingle_sets(buf: np.ndarray, off: np.ndarray, width: int):
    """(values, offsets): the sorted distinct 63-bit shingle hashes of each row."""
    n = len(off) - 1
    row, _, _, h = words(buf, off)
    r, s = shingles(row, h, n, width)
    s = s >> np.uint64(1)
    order = np.argsort(s)
    order = order[np.argsort(r[order].astype(np.uint16 if n < 1 << 16 else np.int64), kind="stable")]
    r, s = r[order], s[order].astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    r, s = r[new], s[new]
    return s, np.concatenate(([0], np.cumsum(np.bincount(r, minlength=n))))


def set_ids(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit identity of each row's set; 0 for an empty one."""
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix(values.astype(np.uint64)), dtype=np.uint64)))
    n = np.diff(at).astype(np.uint64)
    return np.where(n > 0, mix(sums[at[1:]] - sums[at[:-1]] + n) | np.uint64(1), np.uint64(0)).view(np.int64)


def sketches(docs: DataFrame, width: int = WIDTH, k: int = K) -> DataFrame:
    """doc_id, n_shingles, set_id (null: no set), sketch of every row of ``docs`` (doc_id, text)."""
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            for a, b in chunks(off):
                s, at = shingle_sets(buf[off[a]: off[b]], off[a: b + 1] - off[a], width)
                n = np.diff(at)
                ids = set_ids(s, at)
                stay = np.arange(len(s)) - np.repeat(at[:-1], n) < k
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(n, pa.int64()),
                     pa.array(ids, pa.int64(), mask=n == 0),
                     lists(s[stay], np.concatenate(([0], np.cumsum(np.minimum(n, k)))), pa.int64())],
                    ["doc_id", "n_shingles", "set_id", "sketch"])
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, "doc_id BIGINT, n_shingles BIGINT, set_id BIGINT, sketch ARRAY<BIGINT>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """a set_id, values row for each document of ``wanted`` (set_id, doc_id), from its whole text."""
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            for a, b in chunks(off):
                s, at = shingle_sets(buf[off[a]: off[b]], off[a: b + 1] - off[a], width)
                same = np.flatnonzero(set_ids(s, at) == np.asarray(batch.column("set_id").slice(a, b - a)))
                out = pa.RecordBatch.from_arrays([batch.column("set_id").slice(a, b - a), lists(s, at, pa.int64())],
                                                 ["set_id", "values"])
                yield out.take(pa.array(same))
        give_back()

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (text.join(wanted, "doc_id").select("set_id", "text")
            .mapInArrow(run, "set_id BIGINT, values ARRAY<BIGINT>"))


def shared_ids(rows: DataFrame) -> DataFrame:
    """a, b: for each doc_id with several sets, its least set with each other one (rows that
    repeat a doc_id are one document)."""
    known = rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "set_id")
    several = known.groupBy("doc_id").agg(F.min("set_id").alias("a"), F.max("set_id").alias("z")).where("a < z")
    return known.join(several, "doc_id").where("set_id <> a").select("a", F.col("set_id").alias("b")).distinct()


def all_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """set_id, values, once for each document of ``wanted``, also where rows repeat a doc_id."""
    again = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id")
    if again.isEmpty():
        return full_sets(docs, wanted, width)
    once = full_sets(docs, wanted.join(again, "doc_id", "left_anti").select("set_id", "doc_id"), width)
    more = full_sets(docs, wanted.join(again, "doc_id", "left_semi").select("set_id", "doc_id"), width)
    return once.union(more.dropDuplicates(["set_id"]))


def _index(classes: DataFrame, k: int, t: float) -> DataFrame:
    """v, set_id, n, score: the rarest retained values of each class that others retain too."""
    values = classes.select("set_id", "n", F.size("sketch").alias("m"), F.explode("sketch").alias("v"))
    counts = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    hit = values.join(counts, "v")
    own = Window.partitionBy("set_id")  # k rows at most
    slots = F.element_at(F.array(*[F.lit(m - least_shared(m, t) + 1) for m in range(1, k + 1)]), F.col("m"))
    return (hit.withColumn("score", F.sum("df").over(own)).withColumn("seen", F.count("*").over(own))
            .withColumn("r", F.row_number().over(own.orderBy("df", "v")))
            .where(F.col("r") <= slots - (F.col("m") - F.col("seen")))
            .select("v", "set_id", "n", "score"))


def _verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, k: int, low: float, percent: int) -> DataFrame:
    """set_id, o, linked, alike (their similarity) of the pairs (set_id, o, n, on) whose sketches allow a similarity
    of ``low``."""
    sk = classes.select("set_id", "sketch")
    p = (pairs.join(sk.withColumnRenamed("sketch", "sa"), "set_id")
         .join(sk.select(F.col("set_id").alias("o"), F.col("sketch").alias("sb")), "o"))
    p = p.withColumn("u", F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k))
    shared = F.size(F.array_intersect("u", F.array_intersect("sa", "sb")))
    m = F.size("u").cast("double")
    p = p.where(shared >= low * m - 5 * F.sqrt(m * low * (1 - low))).select("set_id", "o", "n", "on")
    x = sets.withColumnRenamed("values", "va")
    y = sets.select(F.col("set_id").alias("o"), F.col("values").alias("vb"))
    both = F.size(F.array_intersect("va", "vb"))
    # the second join has the lists' hot centres as its key: adaptive execution splits them
    p = p.join(x, "set_id").join(y, "o").select("set_id", "o", "n", "on", both.alias("i"))
    union = F.col("n") + F.col("on") - F.col("i")
    return p.select("set_id", "o", (100 * F.col("i") >= percent * union).alias("linked"), (F.col("i") / union).alias("alike"))


def block_links(left: list, right: list, c_left: np.ndarray, c_right: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(index in left, index in right) of links between sets of different components, as many as join
    all components that the block pair's links join."""
    n_left, n_right = len(left), len(right)
    size = np.array([len(x) for x in (*left, *right)])
    owner = np.repeat(np.arange(n_left + n_right), size)
    _, element, count = np.unique(np.concatenate((*left, *right)), return_inverse=True, return_counts=True)
    both = np.zeros((n_left, n_right), np.float32)
    often = count > 16
    column = np.cumsum(often) - 1
    hot = often[element]
    order = np.argsort(element[hot], kind="stable")
    h_owner, h_col = owner[hot][order], column[element[hot]][order]
    for lo in range(0, int(often.sum()), 2048):  # elements of many sets: incidence matrices
        a, b = np.searchsorted(h_col, (lo, lo + 2048))
        m = np.zeros((n_left + n_right, 2048), np.float32)
        m[h_owner[a:b], h_col[a:b] - lo] = 1
        both += m[:n_left] @ m[n_left:].T
    order = np.argsort(element[~hot], kind="stable")
    e, o = element[~hot][order], owner[~hot][order]  # of few sets: the places next to each other
    for lag in range(1, 16):
        same = np.flatnonzero(e[lag:] == e[:-lag]) if len(e) > lag else ()
        if not len(same):
            break
        x, y = np.minimum(o[same], o[same + lag]), np.maximum(o[same], o[same + lag])
        cross = (x < n_left) & (y >= n_left)
        np.add.at(both, (x[cross], y[cross] - n_left), 1)
    links = 100 * both >= percent * (size[:n_left, None] + size[None, n_left:] - both)
    links &= c_left[:, None] != c_right[None, :]
    root: dict[int, int] = {}

    def find(c):
        while root.get(c, c) != c:
            c = root[c]
        return c

    out = []
    for i in np.flatnonzero(links.any(1)).tolist():
        at = np.flatnonzero(links[i])
        for c, first in zip(*(z.tolist() for z in np.unique(c_right[at], return_index=True))):
            x, y = find(int(c_left[i])), find(c)
            if x != y:
                root[x] = y
                out.append((i, int(at[first])))
    return out


def _grouped_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """set_id, o of links inside the groups of ``members`` (g, set_id, c, l, r) that join components: the sets with
    l against those with r."""
    def compare(pdf):
        import pandas as pd
        side = pdf["side"].to_numpy() == 0
        a, b = pdf[side], pdf[~side]
        found = block_links(list(a["values"]), list(b["values"]), a["c"].to_numpy(), b["c"].to_numpy(), percent) if len(
            a) and len(b) else []
        ids_a, ids_b = a["set_id"].to_numpy(), b["set_id"].to_numpy()
        return pd.DataFrame({"set_id": [ids_a[i] for i, _ in found], "o": [ids_b[j] for _, j in found]}, dtype="int64")

    counts = (members.groupBy("g").agg(F.sum(F.col("l").cast("long")).alias("nl"), F.sum(F.col("r").cast("long")).alias("nr"))
              .where("nl > 0 AND nr > 0")
              .select("g", F.ceil(F.col("nl") / BLOCK).cast("int").alias("bl"), F.ceil(F.col("nr") / BLOCK).cast("int").alias("br")))
    m = members.join(counts, "g").withColumn("h", F.xxhash64("set_id"))
    left = m.where("l").select("g", F.expr("pmod(h, bl)").cast("int").alias("i"), F.explode(
        F.sequence(F.lit(0), F.col("br") - 1)).alias("j"), F.lit(0).alias("side"), "set_id", "c")
    right = m.where("r").select("g", F.explode(F.sequence(F.lit(0), F.col("bl") - 1)).alias("i"),
                                F.expr("pmod(h, br)").cast("int").alias("j"), F.lit(1).alias("side"), "set_id", "c")
    return (left.union(right).join(sets, "set_id").groupBy("g", "i", "j")
            .applyInPandas(compare, "set_id BIGINT, o BIGINT"))


def link(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, k: int = K) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text)."""
    t = percent / 100
    rows = written(sketches(docs, width, k), "sketches")
    classes = written(rows.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")), "classes")
    index = written(_index(classes, k, t), "lists")
    listed = classes.join(index.select("set_id").distinct(), "set_id", "left_semi")
    sets = written(all_sets(docs, rows, listed.select("set_id", "doc_id"), width), "sets")

    best = F.max_by(F.struct("set_id", "n"), F.struct("score", "set_id")).alias("f")
    centres = index.groupBy("v").agg(best).select("v", F.col("f.set_id").alias("o"), F.col("f.n").alias("on"))
    stars = written(index.join(centres, "v").where("set_id <> o").select("v", "set_id", "n", "o", "on"), "stars")
    # sizes and sketches only rule out similarities below 2t - 1, not links
    low = max(2 * percent - 100, 0)
    sizes = 100 * F.least("n", "on") >= low * F.greatest("n", "on")
    pairs = written(stars.where(sizes).select("set_id", "o", "n", "on").distinct(), "pairs")
    first = written(_verified(pairs, classes, sets, k, low / 100, percent).where(F.col("alike") >= low / 100), "links")
    edges = first.where("linked").select(F.col("set_id").alias("a"), F.col("o").alias("b")).union(
        written(shared_ids(rows), "shared"))
    labels = components(edges)
    # one group per centre of the sets like it; two per list: its unlike sets against all that aren't linked with the
    # centre, and those between against the unlike ones
    of = labels.select(F.col("v").alias("set_id"), "c")

    def grouped(members):
        return (members.join(of, "set_id", "left").withColumn("c", F.coalesce("c", "set_id"))
                .join(of.select(F.col("set_id").alias("o"), F.col("c").alias("oc")), "o", "left")
                .withColumn("apart", F.col("c") != F.coalesce("oc", "o")))

    like = grouped(first.select(F.xxhash64(F.lit("o"), "o").alias("g"), "set_id", "o")).select(
        "g", "set_id", "c", F.col("apart").alias("l"), F.lit(True).alias("r"))
    rest = (stars.join(first.select("set_id", "o", "linked"), ["set_id", "o"], "left").where("NOT coalesce(linked, false)")
            .select("v", "set_id", "o", F.col("linked").isNull().alias("unlike")))
    rest = grouped(rest.join(rest.where("unlike").select("v").distinct(), "v", "left_semi"))
    below = rest.select(F.xxhash64(F.lit("v"), "v").alias("g"), "set_id", "c", F.expr("apart AND unlike").alias("l"),
                        F.lit(True).alias("r"))
    between = rest.select(F.xxhash64(F.lit("w"), "v").alias("g"), "set_id", "c", F.expr("apart AND NOT unlike").alias("l"),
                          F.col("unlike").alias("r"))
    groups = like.union(below).union(between.where("l OR r"))
    more = written(_grouped_links(written(groups, "groups"), sets, percent), "more")
    edges = edges.union(more.select(F.col("set_id").alias("a"), F.col("o").alias("b")))
    labels = components(edges)
    of_class = classes.select("set_id", "doc_id").join(labels.withColumnRenamed("v", "set_id"), "set_id", "left")
    of_class = of_class.withColumn("c", F.coalesce("c", "set_id"))
    first_doc = of_class.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    found = of_class.join(first_doc, "c").select("set_id", "component_id")
    out = rows.drop("sketch").join(found, "set_id", "left")
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", mine.alias("component_id"),
                      F.coalesce(F.col("doc_id") == mine, F.lit(True)).alias("kept"))
