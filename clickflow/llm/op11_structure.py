"""Conversation structure repair.

A conversation's rows become a signature, one symbol a row: the initial of its role and
whether it is truncated, or that it must go (blank, or equal to an earlier row). Edits
turn the signature into the grammar ``(s?(ua)+)?`` at least cost: Keep 0, Rerole 2,
Delete 3, Insert 2, and 1 for a truncated row that stays; among the cheapest edit
sequences the one with the ASCII-least initials wins.

Signatures are minimised from the end: the distinct ones are dealt by ranges of their
reversed text and sorted, so signatures with a common ending follow one another and share
the automaton nodes of that ending. A task holds the nodes of one path only; a node's
cost-to-go and best audit suffix are computed once for each grammar state, for all
conversations, and a node that several ranges share once in each range.

A signature is cut into blocks of ``block_rows`` rows. The end of a block that isn't its
conversation's last has four outcomes, the grammar states, in place of one. Conversations
of several blocks are settled by composing blocks, ``FAN`` at a time, level by level, and
walking back down with the chosen states: no task holds more than ``FAN`` blocks of a
conversation, however long it is. Only the digest of a conversation, a single SHA-256 and
a single audit string, is by its contract one row's work.

Defined results: a null role or text is one space; rows without conv_id are one
conversation; rows are ordered by turn (nulls first), then role and text; repeated rows
are repeated turns, hence duplicates; an empty role has no initial and is neither s, u nor
a; long texts are whole; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import numbered, written

BLOCK_ROWS, FAN = 512, 256
SPACES = " \t\n\x0b\f\r"
#: Grammar states: 0 nothing yet, 1 after s, 2 after u, 3 after a; END is the end of a conversation.
END = 4
NEXT = {0: (2, "u"), 1: (2, "u"), 2: (3, "a"), 3: (2, "u")}
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
#: What insertions lead to from a state: (state, insertions, roles); going round again never pays.
INSERTED = {q: [(q, 0, ""), (NEXT[q][0], 1, NEXT[q][1])] + (
    [(3, 2, "ua")] if q < 2 else []) for q in range(4)}
DEFAULT_COSTS = {"rerole": 2, "delete": 3, "insert": 2, "truncated": 1}
PATH = "STRUCT<entry: INT, exit: INT, cost: BIGINT, audit: STRING, roles: STRING>"


def leaf(mark: str, insert: int) -> dict:
    """What may follow the last row: {(entry, exit): (cost, audit, roles)}."""
    if mark == "+":  # another block follows
        return {(q, q): (0, "", "") for q in range(4)}
    return {(0, END): (0, "", ""), (1, END): (2 * insert, "II", "ua"), (2, END): (insert, "I", "a"), (3, END): (0, "", "")}


def node(symbol: str, after: dict, costs: dict) -> dict:
    """The best (cost, audit, roles) from each entry to each exit of the node that reads
    ``symbol`` and goes on to the node ``after``."""
    edits = []  # (state before, state after, cost, letter, role)
    low = symbol.lower()
    for p in range(4):
        edits.append((p, p, costs["delete"], "D", "-"))
        if symbol != "x":
            extra = costs["truncated"] if symbol != low else 0
            edits.append((p, NEXT[p][0], costs["rerole"] + extra, "R", NEXT[p][1]))
            if (low, p) in KEEPS:
                edits.append((p, KEEPS[low, p], extra, "K", low))
    by_state = {p: [e for e in edits if e[0] == p] for p in range(4)}
    out: dict = {}
    for q in range(4):
        for p, n, inserted in INSERTED[q]:
            for _, r, c, letter, role in by_state[p]:
                for e in range(END + 1):
                    rest = after.get((r, e))
                    if rest is None:
                        continue
                    cost = n * costs["insert"] + c + rest[0]
                    best = out.get((q, e))
                    if best is None or cost <= best[0]:
                        audit = "I" * n + letter + rest[1]
                        if best is None or (cost, audit) < best[:2]:
                            out[q, e] = (cost, audit, inserted + role + rest[2])
    return out


def solve(signatures: DataFrame, costs: dict = DEFAULT_COSTS) -> DataFrame:
    """signature, paths of the distinct values of the column ``signature`` (symbols and the mark ``$`` or ``+``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, stack = "", []  # the reversed signature last read, and the nodes of its path
        for batch in batches:
            names, paths = [], []
            for text in batch.column("reversed").to_pylist():
                shared = 0
                while shared < min(len(before), len(text)) and before[shared] == text[shared]:
                    shared += 1
                del stack[shared:]
                for symbol in text[shared:]:
                    stack.append(node(symbol, stack[-1], costs) if stack else leaf(symbol, costs["insert"]))
                before = text
                names.append(text[::-1])
                paths.append([{"entry": q, "exit": e, "cost": c, "audit": a, "roles": r}
                              for (q, e), (c, a, r) in sorted(stack[-1].items())])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.list_(pa.struct(
                [("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()),
                 ("roles", pa.string())])))], ["signature", "paths"])

    distinct = signatures.select(F.reverse("signature").alias("reversed")).distinct()
    return (distinct.repartitionByRange("reversed").sortWithinPartitions("reversed")
            .mapInArrow(run, f"signature STRING, paths ARRAY<{PATH}>"))


def compose(blocks: list[dict]) -> list[dict]:
    """For each i, the composition of blocks i, i + 1, ...: {(entry, exit): (cost, rank, state after block i)}.

    A rank orders the audits from one entry to the different exits. Those audits differ
    before either ends, so a rank says all that longer audits need."""
    out: list[dict] = []
    for block in reversed(blocks):
        if not out:
            out.append({k: (c, r, k[1]) for k, (c, r) in block.items()})
            continue
        after, now = out[-1], {}
        for (q, r), (cost, rank) in block.items():
            for (r2, e), (more, rank2, _) in after.items():
                if r2 == r:
                    value = (cost + more, (rank, rank2), r)
                    if (q, e) not in now or value[:2] < now[q, e][:2]:
                        now[q, e] = value
        order = {q: sorted(v[1] for (p, _), v in now.items() if p == q) for q in range(4)}
        out.append({(q, e): (c, order[q].index(k), r) for (q, e), (c, k, r) in now.items()})
    return out[::-1]


_LEVEL = "key STRING, blk BIGINT, entry INT, exit INT, cost BIGINT, rank INT"


def _matrices(rows: pd.DataFrame) -> tuple[list[int], list[dict]]:
    out: dict = {}
    for b, q, e, c, r in rows[["blk", "entry", "exit", "cost", "rank"]].itertuples(index=False):
        out.setdefault(int(b), {})[int(q), int(e)] = (int(c), int(r))
    at = sorted(out)
    return at, [out[b] for b in at]


def _up(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    _, blocks = _matrices(rows)
    whole = compose(blocks)[0]
    return pd.DataFrame([(key[0], int(key[1]), q, e, c, r) for (q, e), (c, r, _) in whole.items()],
                        columns=["key", "blk", "entry", "exit", "cost", "rank"])


def _down(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    state, last = int(rows["from_state"].iloc[0]), int(rows["to_state"].iloc[0])
    at, blocks = _matrices(rows)
    out, suffixes = [], compose(blocks)
    for b, suffix in zip(at, suffixes):
        r = suffix[state, last][2]
        out.append((key[0], b, state, r))
        state = r
    return pd.DataFrame(out, columns=["key", "blk", "entry", "exit"])


def chain(blocks: DataFrame, levels: int, fan: int = FAN) -> DataFrame:
    """key, blk, entry, exit chosen for every block (key, blk, paths) of conversations of several blocks."""
    x = F.col("x")
    level = (blocks.select("key", "blk", "paths", F.explode("paths").alias("x"))
             .select("key", "blk", x["entry"].alias("entry"), x["exit"].alias("exit"), x["cost"].alias("cost"),
                     F.size(F.filter("paths", lambda y: (y["entry"] == x["entry"]) & (y["audit"] < x["audit"]))).alias("rank")))
    stack = [written(level, "structure-level")]
    for _ in range(levels):
        up = stack[-1].groupBy("key", F.expr(f"blk div {fan}").alias("up")).applyInPandas(_up, _LEVEL)
        stack.append(written(up, "structure-level"))
    # one block is left of each conversation: from the start to its end
    chosen = stack[-1].where((F.col("entry") == 0) & (F.col("exit") == END)).select("key", "blk", "entry", "exit")
    for below in reversed(stack[:-1]):
        want = chosen.select("key", F.col("blk").alias("up"), F.col("entry").alias("from_state"), F.col("exit").alias("to_state"))
        chosen = written(below.withColumn("up", F.expr(f"blk div {fan}")).join(want, ["key", "up"])
                         .groupBy("key", "up").applyInPandas(_down, "key STRING, blk BIGINT, entry INT, exit INT"), "structure-path")
    return chosen


def _ordered(items: str, field: str) -> Column:
    return F.concat_ws("", F.transform(F.sort_array(F.collect_list(items)), lambda v: v[field]))


class Repaired:
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.
    ``rows``: conv_id, at, part, turn, edit (K, R or I), role, text of the repaired conversations, to be
    read in the order of (at, part)."""

    def __init__(self, conversations: DataFrame, rows: DataFrame):
        self.conversations, self.rows = conversations, rows


def repair(conversations: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN, costs: dict = DEFAULT_COSTS) -> Repaired:
    """Repair ``conversations`` (conv_id, turn, role, text)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    rows = rows.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    rows = numbered(rows, [F.col(c) for c in ("conv_id", "turn", "role", "text")], "structure-rows")
    # faults of the rows: a few bytes a row from here on
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    light = rows.select("key", "conv_id", "at", "turn", "role", F.sha2("text", 256).alias("sha"), last.alias("last"),
                        F.substring("role", 1, 1).alias("initial"))
    first = light.groupBy("key", "role", "sha").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    light = light.join(first, "at", "left")
    fault = (F.when(F.col("last") == "", "blank").when(F.col("is_first").isNull(), "duplicate")
             .when(~F.col("last").isin(".", "!", "?"), "truncated"))
    light = light.withColumn("fault", fault).withColumn(
        "initial", F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o"))
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
              .when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial")))
    item = F.struct("at", symbol.alias("symbol"), "initial")
    blocks = light.withColumn("item", item).groupBy("key", F.expr(f"at div {block_rows}").alias("blk")).agg(
        F.first("conv_id").alias("conv_id"), F.min("at").alias("first_at"),
        _ordered("item", "symbol").alias("symbols"), _ordered("item", "initial").alias("initials"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    blocks = written(blocks, "structure-blocks")
    # a conversation's blocks follow one another without a gap
    ends = blocks.select("key", (F.col("blk") - 1).alias("blk"), F.substring("initials", 1, 1).alias("next_initial"))
    starts = blocks.select("key", (F.col("blk") + 1).alias("blk"), F.lit(True).alias("has_previous"))
    blocks = blocks.join(ends, ["key", "blk"], "left").join(starts, ["key", "blk"], "left")
    pairs = F.concat("initials", F.coalesce("next_initial", F.lit("")))
    illegal = F.size(F.filter(F.sequence(F.lit(1), F.length(pairs)), lambda i: (i < F.length(pairs))
                              & ~F.substring(pairs, i, F.lit(2)).isin("su", "ua", "au")))
    several = F.col("next_initial").isNotNull() | F.col("has_previous").isNotNull()
    blocks = written(blocks.select(
        "key", "conv_id", "blk", "first_at", "blank", "duplicate", "truncated", illegal.alias("illegal"), several.alias("several"),
        F.concat("symbols", F.when(F.col("next_initial").isNull(), "$").otherwise("+")).alias("signature")), "structure-blocks")
    solved = written(blocks.join(solve(blocks, costs), "signature"), "structure-solved")
    alone = solved.where("NOT several").withColumn("path", F.filter(
        "paths", lambda p: (p["entry"] == 0) & (p["exit"] == END))[0])
    # the number of levels: two numbers reach the driver, and a conversation's blocks shrink by ``fan`` a level
    span = solved.where("several").groupBy("key").agg(F.min("blk").alias("a"), F.max("blk").alias("b")).agg(
        F.max(F.col("b") - F.col("a")).alias("span"), F.max("b").alias("last")).first()
    edited = alone.drop("paths")
    if span["span"] is not None:
        linked = solved.where("several")
        shift = linked.groupBy("key").agg(F.min("blk").alias("base"))  # numbered from 0 in each conversation
        linked = written(linked.join(shift, "key").withColumn("blk", F.col("blk") - F.col("base")).drop("base"), "structure-linked")
        levels, left = 0, span["span"]
        while left:
            left, levels = left // fan, levels + 1
        chosen = chain(linked, levels, fan)
        edited = edited.unionByName(linked.join(chosen, ["key", "blk"]).withColumn("path", F.filter(
            "paths", lambda p: (p["entry"] == F.col("entry")) & (p["exit"] == F.col("exit")))[0]).drop("paths", "entry", "exit"))
    edited = written(edited, "structure-edited")
    turns = (light.where("turn IS NOT NULL").groupBy("key", "turn").agg(F.lit(1).alias("one"))
             .groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))
    audits = edited.withColumn("item", F.struct("blk", F.col("path.audit").alias("audit"))).groupBy("key").agg(
        F.first("conv_id").alias("conv_id"), *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.sum("path.cost").alias("cost"), _ordered("item", "audit").alias("audit"))
    audits = audits.join(turns, "key", "left").select(
        "conv_id", F.coalesce("gaps", F.lit(0)).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repaired(audits, _apply(rows, edited))


def _apply(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """The repaired rows: each row meets its own edits by its place, and insertions stand before it."""
    audit, roles = F.col("path.audit"), F.col("path.roles")
    pieces = F.regexp_extract_all(audit, F.lit("I*[KRD]|I+$"), F.lit(0))
    # the letters before each piece, to cut the roles alike
    steps = edited.select("conv_id", "first_at", roles.alias("roles"), F.posexplode(pieces).alias("i", "piece"),
                          F.transform(pieces, lambda p: F.length(p)).alias("sizes"))
    begin = F.aggregate(F.slice("sizes", F.lit(1), F.col("i")), F.lit(0), lambda a, b: a + b)
    steps = steps.select("conv_id", "first_at", "i", "piece", F.substring(
        F.col("roles"), begin + 1, F.length("piece")).alias("piece_roles"))
    steps = steps.withColumn("row", F.col("piece").rlike("[KRD]$"))
    mine = steps.where("row").select((F.col("first_at") + F.col("i")).alias("at"), "piece", "piece_roles")
    added = steps.where("NOT row").select("conv_id", (F.col("first_at") + F.col("i")).alias("at"), "piece", "piece_roles")
    full = F.when(F.col("r") == "u", "user").when(F.col("r") == "a", "assistant")
    letters = F.posexplode(F.transform(F.sequence(F.lit(1), F.length("piece")), lambda i: F.struct(
        F.substring("piece", i, F.lit(1)).alias("e"), F.substring("piece_roles", i, F.lit(1)).alias("r")))).alias("part", "x")
    changed = rows.join(mine, "at").select("conv_id", "at", "turn", "role", "text", letters).select(
        "*", F.col("x.e").alias("edit"), F.col("x.r").alias("r")).where("edit != 'D'").select(
        "conv_id", "at", "part", F.when(F.col("edit") != "I", F.col("turn")).alias("turn"), "edit",
        F.when(F.col("edit") == "K", F.col("role")).otherwise(full).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))
    # insertions after a conversation's last row: at the place after it, before any other conversation's part there
    tail = added.select("conv_id", "at", letters).select(
        "conv_id", (F.col("at") - 1).alias("at"), (F.col("part") + 1000).alias("part"), F.lit(None).cast("long").alias("turn"),
        F.lit("I").alias("edit"), F.col("x.r").alias("r")).select("conv_id", "at", "part", "turn", "edit", full.alias("role"), F.lit("").alias("text"))
    return changed.unionByName(tail)


def digests(rows: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the repaired rows: `role:text`, joined by newlines. A task
    streams a conversation's rows in order and holds one batch of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, conv, h, out = None, None, None, []
        for batch in batches:
            for k, c, role, text in zip(*(batch.column(n).to_pylist() for n in ("key", "conv_id", "role", "text"))):
                if k != key:
                    if h is not None:
                        out.append((conv, h.hexdigest()))
                    key, conv, h = k, c, hashlib.sha256()
                else:
                    h.update(b"\n")
                h.update(f"{role}:{text}".encode())
            if len(out) > 10000:
                yield _digest_batch(out)
                out = []
        if h is not None:
            out.append((conv, h.hexdigest()))
        if out:
            yield _digest_batch(out)

    rows = rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"), "conv_id", "at", "part", "role", "text")
    return (rows.repartition("key").sortWithinPartitions("key", "at", "part")
            .mapInArrow(run, "conv_id BIGINT, repaired_sha256 STRING"))


def _digest_batch(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())],
                                      ["conv_id", "repaired_sha256"])


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after faults chosen by crc32 of `conv_id:turn` mod 20; a null is one space."""
    space = F.lit(" ")
    text = F.coalesce(F.col("text").cast("string"), space)
    h = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                         F.coalesce(F.col("turn").cast("string"), space))) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), h.alias("__h"),
        F.when(h == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space)).alias("role"),
        F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
    copies = F.when(F.col("__h") == 0, 0).when(F.col("__h") == 3, 2).otherwise(1)
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), copies)).alias("__c")).drop("__c")


def repaired_digests(conversations: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """One row per conv_id of ``conversations``: its damage, the cost and audit of its repair and the digest of the result."""
    done = repair(damage(conversations), block_rows, fan)
    ids = conversations.select(F.col("conv_id").cast("long").alias("id")).distinct()
    a, d = done.conversations.alias("a"), digests(done.rows).alias("d")
    zero = [F.coalesce(F.col(f"a.{c}"), F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (ids.join(a, F.col("id").eqNullSafe(F.col("a.conv_id")), "left")
            .join(d, F.col("id").eqNullSafe(F.col("d.conv_id")), "left")
            .select(F.col("id").alias("conv_id"), *zero, F.coalesce("a.audit", F.lit("")).alias("audit"),
                    F.coalesce("d.repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))
