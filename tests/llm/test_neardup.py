import math
import random

from clickflow.llm import op2_minhash as M
from clickflow.llm.graph import components

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width=3, percent=85):
    sets = []
    for d, t in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        s = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        sets.append((d, s))
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for d, s in sets:
        for x in s:
            by.setdefault(x, []).append(d)
    of = dict(sets)
    seen = set()
    for ds in by.values():
        for i, a in enumerate(ds):
            for b in ds[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    n = len(of[a] & of[b])
                    if 100 * n >= percent * len(of[a] | of[b]):
                        x, y = sorted((find(a), find(b)))
                        parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_matches_brute_force_on_table(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(M.link(docs)) == brute(rows)


def test_chains_and_groups(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(4000)]
    rows, n = [], 0
    passage = [rng.choice(vocab) for _ in range(40)]
    for g in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([6, 25, 80, 300]))] + passage
        for _ in range(rng.choice([1, 2, 9, 30])):
            t = list(base)
            for _ in range(int(len(t) * rng.choice([0, 0.01, 0.02, 0.04]))):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((n, " ".join(t)))
            n += 1
    chain = [rng.choice(vocab) for _ in range(200)]
    for _ in range(12):  # each step is close to the next only
        rows.append((n, " ".join(chain)))
        n += 1
        for i in range(4):
            chain[rng.randrange(200)] = rng.choice(vocab)
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    for width, percent in ((3, 85), (5, 80)):
        assert got(M.link(df, width, percent)) == brute(rows, width, percent)


def test_links_between_members_that_miss_a_hub(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for _ in range(12):  # truncations of a hub's text: the short ones are linked with long ones, not with the hub
        hub = [f"w{rng.randrange(10 ** 9)}" for _ in range(202)]
        for size in (202, 202, 182, 162, 145, 130, 117):
            extra = [f"w{rng.randrange(10 ** 9)}"] if size == 202 else []
            rows.append((n, " ".join(hub[:size] + extra)))
            n += 1
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    for width, percent in ((3, 85), (5, 80)):
        assert got(M.link(df, width, percent)) == brute(rows, width, percent)


def test_edge_rows(spark, edge, none):
    out = [tuple(r) for r in M.link(edge).collect()]
    assert len(out) == edge.count()
    by = {}
    for d, n, c, k in out:
        by.setdefault(d, []).append((n, c, k))
    assert by[2] == by[3] == [(0, 2, True)] or (by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)])
    assert by[8] == [(4, 8, True)] and by[9] == [(4, 8, False)] * 2
    assert all(c is None and k for _, c, k in by[None])
    assert by[5] == [(1, 5, True)] and by[6] == [(1, 6, True)]
    assert M.link(none).count() == 0


def test_least_shared_is_a_safe_bound():
    for t in (0.8, 0.85):
        # a sketch smaller than k is the whole set, of which t times its size at least is shared
        assert all(1 <= M.least_shared(m, t) <= math.ceil(t * m) for m in range(1, M.K + 1))
        need = M.least_shared(M.K, t)
        assert sum(math.comb(M.K, i) * t ** i * (1 - t) ** (M.K - i) for i in range(need)) < 1e-5


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 103), (200, 199)] + [(300, 300 + i) for i in range(1, 50)]
    got_ = {r.v: r.c for r in components(spark.createDataFrame(edges, "a BIGINT, b BIGINT")).collect()}
    assert all(got_[i] == 0 for i in range(41)) and got_[103] == 100 and got_[200] == 199 and got_[349] == 300


def test_rows_that_repeat_a_doc_id(spark):
    """Rows with one doc_id are one document, with the links of all its texts; SQL agrees."""
    import duckdb
    from clickflow.llm.oracle_sql import SQL
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(2, a), (5, a), (5, b), (9, b), (7, c), (None, c), (11, b.upper()), (11, b)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    out = sorted((r.doc_id or -1, r.component_id) for r in M.link(df).collect())
    assert out == [(-1, None), (2, 2), (5, 2), (5, 2), (7, 7), (9, 2), (11, 2), (11, 2)]
    con = duckdb.connect()
    con.register("documents", df.where("doc_id IS NOT NULL").toArrow())
    con.execute(SQL["op2_minhash_neardup"])
    names = [x[0] for x in con.description]
    want = {dict(zip(names, r))["doc_id"]: dict(zip(names, r))["component_id"] for r in con.fetchall()}
    assert want == {d: k for d, k in out if d > 0}


def test_copies_of_rows_give_one_set(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near = text.replace("w59", "other")
    df = spark.createDataFrame([(1, text)] * 200 + [(2, near)] * 200, "doc_id BIGINT, text STRING").repartition(4)
    rows = M.sketches(df)
    wanted = rows.groupBy("set_id").agg({"doc_id": "min"}).withColumnRenamed("min(doc_id)", "doc_id")
    assert M.all_sets(df, rows, wanted, M.WIDTH).count() == 2
    assert {(r.doc_id, r.component_id) for r in M.link(df).collect()} == {(1, 1), (2, 1)}
