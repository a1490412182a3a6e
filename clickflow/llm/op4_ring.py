"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on the ring of 32-bit hashes; a document's
point is the hash of its doc_id, and its arc (the stretch up to the next virtual
node) names the shard that it asks first. A shard takes at most its capacity;
what overflows goes on clockwise to the next virtual node of another shard.
Under the law ``rows`` the capacities are the row count divided by the shards,
the first shards by number taking the remainder, so counts differ by one at
most, whatever the hashes do.

All documents of one arc meet the shards in the same order, so only the number
of documents per arc (``shards * vnodes`` numbers, a parameter, whatever the
table's size) is needed to settle which ranks of an arc go where: ``ring_plan``.
Documents are joined to their arc by an equality on the leading bits of the hash
and ranked in it by (hash, doc_id, text CRC), by places in ranges of the whole order, so
that a hot arc is spread over tasks. The main path is DataFrame operations only. Hashes take doc_id alone, so copies of one text spread evenly.

Defined results: a null text has size 1 and CRC 0, like an empty one; rows with a
null doc_id have the point of the word "null" and repeated doc_ids one point,
ranked in any order among themselves; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import numbered, written

SHARDS, VNODES = 16, 64
RING = 1 << 32
#: Leading bits of a hash by which documents and arcs are joined.
BITS = 10


def point_of(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def ring_points(shards: int = SHARDS, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) of all virtual nodes, clockwise."""
    return sorted((point_of(f"shard-{s}-{v}"), s) for s in range(shards) for v in range(vnodes))


def arcs(points: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(arc, low, high): hashes low <= h < high belong to the virtual node ``arc``; the stretch
    beyond the last node is the first node's."""
    out, low = [], 0
    for i, (p, _) in enumerate(points):
        out.append((i, low, p + 1))
        low = p + 1
    return [(i, a, b) for i, a, b in [*out, (0, low, RING)] if a < b]


def ring_plan(counts: dict[int, int], points: list[tuple[int, int]], capacity: list[int]) -> list[tuple]:
    """(arc, first rank, end rank, shard, first slot): where the documents of each arc go.

    Arcs step on together, one virtual node per round: a shard takes what it has room for, in the
    ring's order of the arcs, and the rest of an arc walks on to the next virtual node."""
    n, room = len(points), list(capacity)
    done = {a: 0 for a in counts}
    plan, waiting = [], sorted(counts)
    for step in range(n):
        rest = []
        for a in waiting:
            s = points[(a + step) % n][1]
            take = min(room[s], counts[a] - done[a])
            if take:
                plan.append((a, done[a], done[a] + take, s, capacity[s] - room[s]))
                done[a] += take
                room[s] -= take
            if done[a] < counts[a]:
                rest.append(a)
        if not rest:
            break
        waiting = rest
    return plan


def row_capacity(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _arc_table(spark: SparkSession, points) -> DataFrame:
    """arc, low, high, lead: one row for each leading-bits cell that an arc touches
    (at most arcs + 2 ** BITS rows)."""
    shift = 32 - BITS
    rows = [(i, a, b, lead) for i, a, b in arcs(points) for lead in range(a >> shift, (b - 1 >> shift) + 1)]
    return spark.createDataFrame(rows, "arc INT, low BIGINT, high BIGINT, lead BIGINT")


def shard_documents(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 8), 16, 10)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), key.cast("long").alias("h"))
    # texts are read once: their sizes and sums, a few bytes a row, are kept
    base = written(base, "ring")
    # bounded by shards * vnodes + 2 ** BITS rows, so its broadcast doesn't grow with the data
    table = F.broadcast(_arc_table(spark, points))
    at = (base.withColumn("lead", F.shiftright("h", 32 - BITS)).join(table, "lead")
          .where("h >= low AND h < high").drop("low", "high", "lead"))
    counts = {r["arc"]: r["n"] for r in at.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    plan = ring_plan(counts, points, row_capacity(sum(counts.values()), shards))
    before, total = {}, 0  # rows of the arcs before each
    for a in sorted(counts):
        before[a], total = total, total + counts[a]
    moves = spark.createDataFrame([(*m, before[m[0]]) for m in plan],
                                  "arc INT, lo BIGINT, hi BIGINT, shard INT, first BIGINT, before BIGINT")
    # places over all arcs come from ranges of rows: an arc, or one doc_id, may hold a third of the table
    placed = numbered(at, [F.col(c) for c in ("arc", "h", "doc_id", "text_crc32")], "ring-order")
    # at most shards * vnodes * (vnodes passed) rows, and in practice one or two for each arc
    return (placed.join(F.broadcast(moves), "arc").withColumn("rank", F.col("at") - F.col("before"))
            .where("rank >= lo AND rank < hi")
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    (F.col("first") + F.col("rank") - F.col("lo")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
