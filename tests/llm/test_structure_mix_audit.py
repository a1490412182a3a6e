import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickflow.llm import op11_structure as R, op12_mixing as M, op13_divergence as D
from clickflow.llm.common import numbered
from clickflow.llm.oracle_sql import SQL
from clickflow.llm.queries import QUERIES

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def duck(**tables):
    import duckdb
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    return con


def same(spark_df, con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = Counter(map(repr, cur.fetchall()))
    got = Counter(repr(tuple(r)) for r in spark_df.select(names).collect())
    assert got == want, ((got - want).most_common(3), (want - got).most_common(3))


def test_numbered_places(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.lit("x").alias("same"))
    out = numbered(df, [F.col("g"), F.col("same")], "t").orderBy("at").collect()
    assert [r.at for r in out] == list(range(1000)) and [r.g for r in out] == sorted(r.g for r in out)


# --- op11 ---

def cheapest(rows):
    """(cost, audit, repaired rows) by uniform-cost search over (row, state, audit); ``rows``: (initial, role, text, must go, truncated)."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit, out
        if (i, q, audit) in done:
            continue
        done.add((i, q, audit))
        step, name = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[q]
        if len(audit) < 3 * len(rows) + 3:
            heapq.heappush(heap, (cost + 2, audit + "I", i, step, out + ((name, ""),)))
        if i < len(rows):
            initial, role, text, gone, cut = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, out))
            if not gone:
                heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, step, out + ((name, text),)))
                keep = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}.get((initial, q))
                if keep:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, keep, out + ((role, text),)))


def structure_brute(rows):
    """{conv_id: the columns of op11's query} of undamaged ``rows`` (conv_id, turn, role, text)."""
    out, by = {}, defaultdict(list)
    for c, t, role, text in rows:
        by[c]
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        role = "user" if k == 4 else role
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        by[c] += [(t, role, text)] * {0: 0, 3: 2}.get(k, 1)
    for c, turns in by.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode()))
        seen, items, counts = set(), [], Counter()
        for _, role, text in turns:
            marks = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = ("blank" if not marks else "duplicate" if (role, text) in seen
                     else "truncated" if marks[-1] not in ".!?" else None)
            seen.add((role, text))
            counts[fault] += 1
            items.append((role[:1], role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        known = [t for t, *_ in turns if t is not None]
        cost, audit, done = cheapest(items)
        out[c] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, counts["blank"], counts["duplicate"],
                  counts["truncated"], sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(items, items[1:])),
                  cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest())
    return out


def conversations(seed=5):
    rng, rows = random.Random(seed), []
    roles = ["system", "user", "assistant", "tool", None, "", "agent"]
    texts = ["Yes.", "No!", "cut off", "", None, " \n", "Why?", "same text", "end.  \n"]
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 7)):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.7 else rng.choice(roles)
            rows.append((c, t if rng.random() < 0.9 else rng.choice([None, t - 1, t + 3]), role, rng.choice(texts) if rng.random() < 0.6 else f"turn {t}."))
    return rows


CONV = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
FIELDS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("block, fan", [(512, 256), (2, 2)])
def test_structure_equals_search(spark, block, fan):
    rows = conversations()
    df = spark.createDataFrame(rows, CONV).withColumns({c: F.lit("x") for c in ("key", "at", "blk", "edit", "path", "item")})
    out = R.repaired_digests(df, block, fan).collect()
    want = structure_brute(rows)
    assert {r.conv_id: tuple(r[f] for f in FIELDS) for r in out} == want and len(out) == len(want)


def test_structure_hot_conversation_and_sql(spark):
    """A conversation with a third of all rows is settled in blocks of blocks, as in one piece; SQL agrees."""
    rng = random.Random(2)
    rows = conversations(9) + [(1000, t, rng.choice(["user", "assistant", "user", "assistant", "system"]),
                                rng.choice([f"turn {t}.", f"turn {t}", "again.", ""])) for t in range(150)]
    rows = [(c, t, r or "x", x) for c, t, r, x in rows]
    df = spark.createDataFrame(rows, CONV)
    con = duck(conversations=df)
    same(R.repaired_digests(df, 8, 3), con, SQL["op11_structure_repair"])
    same(R.repaired_digests(df), con, SQL["op11_structure_repair"])


def test_structure_rows_and_edges(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, "user", "Who?"),
                                (2, 0, None, None), (3, 0, "user", "x" * 100000 + ".")], CONV)
    done = R.repair(df)
    rows = [(r.conv_id, r.edit, r.role, r.text[:5]) for r in done.rows.orderBy("conv_id", "at", "part").collect()]
    assert {r.conv_id: r.audit for r in done.conversations.collect()} == {1: "IKDKI", 2: "D", 3: "KI"}
    assert rows == [(1, "I", "user", ""), (1, "K", "assistant", "Hi."), (1, "K", "user", "Who?"), (1, "I", "assistant", ""), (3, "K", "user", "xxxxx"), (3, "I", "assistant", "")]
    assert R.repaired_digests(spark.createDataFrame([], CONV)).count() == 0


def test_structure_shares_nodes():
    """Signatures with a common ending give the same paths, whatever stands before."""
    after = R.leaf("$", 2)
    for s in "auau":
        after = R.node(s, after, R.DEFAULT_COSTS)
    assert after[0, R.END][:2] == (0, "KKKK") and after[2, R.END][0] == 2
    blocks = [{(0, 2): (0, 0)}, {(2, 3): (1, 0), (2, 2): (0, 1)}, {(3, 4): (0, 0), (2, 4): (1, 0)}]
    assert R.compose(blocks)[0][0, 4] == (1, 0, 2)


# --- op12 ---

def test_mixing_equals_sql(spark, edge, docs):
    same(M.mix(docs), duck(documents=docs), SQL["op12_pareto_mixing"])
    again = docs.unionByName(docs.limit(20)).unionByName(docs.limit(5).withColumn("source", F.lit(None).cast("string")))
    same(M.mix(again), duck(documents=again), SQL["op12_pareto_mixing"])
    same(M.mix(edge), duck(documents=edge.select("doc_id", "text", "source")), SQL["op12_pareto_mixing"])


def test_mixing_targets(spark, none):
    rows = [(i, "w " * n, "en", s, 0) for i, (n, s) in enumerate(
        [(10, "a"), (10, "b"), (1000, "b"), (5, "c"), (0, "d"), (7, None), (900, "e"), (900, "e")])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    out = M.mix(docs).collect()
    size = {"a": 10, "b": 1010, "c": 5, "d": 0, "e": 1800, None: 7}
    weight = dict(zip(["a", "b", "c", "d", "e", None], [1, 2, 3, 1, 2, 3]))
    target, held = {}, set()
    while True:  # the rule as it is stated
        left = sum(size.values()) - sum(3 * size[s] for s in held)
        free = [s for s in size if s not in held]
        target = {s: 3 * size[s] if s in held else left * weight[s] / sum(weight[x] for x in free) for s in size}
        over = {s for s in free if target[s] > 3 * size[s]}
        if not over:
            break
        held |= over
    assert {r.source: (r.source_size, pytest.approx(r.target)) for r in out} == {s: (size[s], target[s]) for s in size}
    assert all(r.taken == r.copies * r.size and r.copies <= 3 for r in out)
    assert M.mix(none).count() == 0


def test_mixing_near_target_with_hot_source(spark):
    """A source with a third of the rows, long documents among short ones: the words taken meet the target."""
    rng = random.Random(4)
    rows = [(i, "w " * (rng.choice([1, 3, 20, 90, 300]) + rng.randint(0, 9) + (4000 if i % 300 == 0 else 0)), "en",
             "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    out = M.mix(docs)
    for r in out.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n")).collect():
        assert abs(r.n - r.t) < 0.01 * r.t
    assert sorted(out.collect()) == sorted(M.mix(docs.repartition(7)).collect())  # reruns agree


def test_pareto_inclusion(spark):
    """Over many seeds every document of a class is drawn about equally often."""
    docs = spark.createDataFrame([(i, "w " * 100, "en", "a" if i < 40 else "b", 0) for i in range(80)],
                                 "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")
    drawn = Counter()
    for s in range(6):
        for r in M.mix(docs, (1, 3), seed=f"s{s}").where("source = 'a'").collect():
            drawn[r.doc_id] += r.copies
    assert sum(drawn.values()) == 6 * 20 and max(drawn.values()) < 7 and len([d for d in drawn if drawn[d]]) > 30


# --- op13 ---

def test_transducer_is_minimal_and_ordered():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abé日") for _ in range(rng.randint(1, 6))).encode() for _ in range(600)})
    t = D.Transducer.build(words)
    t = D.Transducer.read(*t.fields(), t.root)
    others = [w + b"x" for w in words[:50]] + [b"", b"zz", words[-1] + words[-1], words[0][:1]]
    off = np.concatenate(([0], np.cumsum([len(w) for w in words + others])))
    got = t.ordinals(np.frombuffer(b"".join(words + others), np.uint8), off)
    place = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [place.get(w, -1) for w in words + others]
    assert [t.term(i) for i in range(len(words))] == words
    # minimal: as many states as there are different sets of endings
    endings = {frozenset(w[len(p):] for w in words if w.startswith(p)) for p in {w[:i] for w in words for i in range(len(w) + 1)}}
    assert len(t.final) == len(endings)


@pytest.mark.parametrize("shard_terms", [None, 7])
def test_audit_equals_sql(spark, edge, docs, shard_terms):
    con = duck(documents=docs)
    same(D.audit(docs, shard_terms=shard_terms), con, SQL["op13_source_divergence"])


def test_audit_edges(spark, edge, none, monkeypatch):
    more = edge.unionByName(edge).unionByName(edge.withColumn("lang", F.lit("fr"))).unionByName(
        edge.limit(2).withColumn("lang", F.lit("solo")))
    same(D.audit(more), duck(documents=more.select("doc_id", "text", "lang", "source")), SQL["op13_source_divergence"])
    monkeypatch.setattr(D, "SLICE", 2)  # several slices and blocks of sources
    monkeypatch.setattr(D, "BLOCK", 2)
    same(D.audit(more), duck(documents=more.select("doc_id", "text", "lang", "source")), SQL["op13_source_divergence"])
    assert D.audit(none).count() == 0


def test_registered(spark):
    assert QUERIES["op11_structure_repair"](spark, SF).count() > 0
