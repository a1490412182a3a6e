import re
import zlib
from collections import Counter

import numpy as np
import pytest

from clickflow.llm import op4_ring as S, op9_hosts as H, op10_langid as L

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ring_brute(rows, shards=S.SHARDS, vnodes=S.VNODES):
    """The ring walked document by document, in the rounds of the plan."""
    points = S.ring_points(shards, vnodes)
    room = S.row_capacity(len(rows), shards)
    order = []
    for d, t in rows:
        h = S.point_of("null" if d is None else str(d))
        arc = next((i for i, (p, _) in enumerate(points) if h <= p), 0)
        order.append((arc, h, (d is not None, d or 0), zlib.crc32((t or "").encode()), d))
    order.sort(key=lambda x: x[:4])
    where, waiting, step = {}, order, 0
    while waiting:
        rest = []
        for x in waiting:
            s = points[(x[0] + step) % len(points)][1]
            if room[s]:
                room[s] -= 1
                where.setdefault(x[4], []).append(s)
            else:
                rest.append(x)
        waiting, step = rest, step + 1
    return where


def test_ring_equals_walk(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = S.shard_documents(docs).collect()
    assert {r.doc_id: [r.shard] for r in out} == ring_brute(rows)
    texts = dict(rows)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
               and r.law == "rows" and r.grown_shard is None for r in out)
    check_slots(out, len(rows))


def check_slots(out, n):
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(16)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_ring_with_a_hot_key(spark):
    """A doc_id with a third of all rows: one point, one arc, and still sizes one apart and gapless slots."""
    rows = [(1, f"t{i}") for i in range(400)] + [(None, f"u{i}") for i in range(100)] + [(i, "x") for i in range(2, 500)]
    out = S.shard_documents(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(5)).collect()
    check_slots(out, len(rows))
    want = ring_brute(rows)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r.shard)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_ring_edges(spark, edge, none):
    out = S.shard_documents(edge).collect()
    check_slots(out, len(EDGE))
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in out) == sorted(
        (d or -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in EDGE)
    assert S.shard_documents(none).count() == 0
    one = spark.createDataFrame([(5, "x")] * 40, "doc_id BIGINT, text STRING")  # all rows at one point
    check_slots(S.shard_documents(one).collect(), 40)


def test_ring_moves_little():
    """With room to spare, one more shard moves about its share of the arcs and no more than twice that."""
    def places(shards):
        points = S.ring_points(shards)
        counts = {i: 0 for i in range(len(points))}
        keys = [S.point_of(str(k)) for k in range(4000)]
        arc = [next((i for i, (p, _) in enumerate(points) if h <= p), 0) for h in keys]
        for a in arc:
            counts[a] += 1
        plan = S.ring_plan({a: n for a, n in counts.items() if n}, points, [int(4000 / shards * 1.25) + 1] * shards)
        seen, out = Counter(), []
        for h, a in sorted(zip(keys, arc)):
            r = seen[a]
            seen[a] += 1
            out.append((h, next(s for b, lo, hi, s, _ in plan if b == a and lo <= r < hi)))
        return dict(out)
    a, b = places(16), places(17)
    moved = sum(a[h] != b[h] for h in a) / len(a)
    assert moved < 0.2


def base_brute(t):
    w = WORD.findall(t or "")
    g = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    n = Counter(g)
    cover = {j for i, x in enumerate(g) if n[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(cover),
            len(w) < 20 or 100 * len(cover) > 30 * len(w))


def stats(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_statistics_equal_brute_force(spark, docs, edge, none):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    out = H.judge(docs).collect()
    assert len(out) == len(texts) and all(stats(r) == base_brute(texts[r.doc_id]) for r in out)
    made = ["a b c d e f g h i " * 3, "x\ny\nx\n\n \n\nx", "#*# $$ <a> & | %", "a\x0bb\x0cc\rd e", "one two three four five six seven "
            "eight " * 2 + "end", "a " * 40, "  a b"]
    df = spark.createDataFrame([(i, t, "h") for i, t in enumerate(made)], "doc_id BIGINT, text STRING, source STRING")
    assert {r.doc_id: stats(r) for r in H.judge(df).collect()} == {i: base_brute(t) for i, t in enumerate(made)}
    assert Counter(map(stats, H.judge(edge).collect())) == Counter(base_brute(t) for _, t, *_ in EDGE)
    assert H.judge(none).count() == 0


def test_host_verdicts(spark):
    good = " ".join(f"w{i}" for i in range(40))
    rows = [(i, "spam", "bad.example") for i in range(90)] + [(100 + i, good, "bad.example") for i in range(10)]
    for h in range(30):
        rows += [(1000 + 100 * h + i, good if i else "short", f"host{h}") for i in range(20)]
    rows += [(9000, "short", "tiny.example"), (9001, good, "tiny.example"), (9002, good, None)]
    out = {r.doc_id: r for r in H.judge(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING")).collect()}
    assert not any(out[100 + i].kept for i in range(10))  # good pages of a bad host go
    assert out[9001].kept and out[9002].kept  # one failure of two doesn't condemn a small host
    assert all(out[1000 + 100 * h + 1].kept for h in range(30))
    # shrunk rate = (failures + mean * strength) / (rows + strength)
    assert out[9001].host_rate < 0.5 and out[100].host_rate > 0.8


def parse_brute(text, sample):
    """Phrases of the greedy parse of ``text`` into substrings of ``sample``, in lanes."""
    n = 0
    for a in range(0, len(text), L.LANE):
        cur = ""
        n += 1
        for c in text[a: a + L.LANE]:
            if cur + c in sample:
                cur += c
            else:
                n += 1
                cur = c if c in sample else ""
    return n


def symbols(t):
    return re.sub(r"[\W\d_]+", " ", t.lower()).lstrip(" ")


def test_phrases_equal_brute_force():
    samples = {"x": ["abcabd abe bcd " * 5], "y": ["zyx zzy xyz yyx"]}
    m = L.Model(samples)
    texts = ["abcabc zyx", "", "qqq", "abd " * 300, "zyxab", "abe1bcd--zz"]
    buf, off = L.utf8(__import__("pyarrow").array(texts))
    sym, at, _ = L.letters(buf, off)
    got = m.phrases(sym, at)
    kept = {k: symbols(v[0]) for k, v in samples.items()}
    for i, t in enumerate(texts):
        s = symbols(t)
        assert "".join(map(chr, sym[at[i]: at[i + 1]])) == s
        assert [int(got[j, i]) for j in range(2)] == [parse_brute(s, kept[k]) for k in ("x", "y")]


def test_automaton_accepts_exactly_the_substrings():
    rng = np.random.default_rng(2)
    text = rng.integers(1, 4, 60).tolist()
    t = L.suffix_automaton(text, 4)
    subs = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, 61)}
    for n in (1, 2, 4, 7):
        for _ in range(200):
            w = tuple(rng.integers(1, 4, n).tolist())
            s = 1
            for c in w:
                s = t[s, c] if s else 0
            assert bool(s) == (w in subs)


def test_languages_of_wide_alphabets():
    rng = np.random.default_rng(4)
    make = lambda first, n: "".join(chr(first + int(c)) for c in rng.integers(0, n, 400))
    samples = {"en": [make(97, 26) * 5], "ru": [make(0x430, 32) * 2], "zh": [make(0x4E00, 3000)], "zu": [make(0x6E00, 3000)]}
    m = L.Model(samples)
    texts = [samples["zh"][0][40:90], samples["zu"][0][200:260], samples["ru"][0][9:80], samples["en"][0][5:50],
             samples["zh"][0][:7] + samples["zu"][0][3:9] + "\u9fa0" + samples["ru"][0][:9]]
    buf, off = L.utf8(__import__("pyarrow").array(texts))
    sym, at, _ = L.letters(buf, off)
    got = m.phrases(sym, at)
    assert [[int(n) for n in row] for row in got] == [
        [parse_brute(symbols(t), symbols(samples[k][0]) + " ") for t in texts] for k in m.langs]
    langs, scores = m.predict(buf, off)[:2]
    assert langs[:4] == ["zh", "zu", "ru", "en"] and min(scores[:4]) > 0.9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in out.items())
    held = [d for d, r in out.items() if r.held_out]
    assert sum(out[d].lang_pred == truth[d] for d in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in out.values())


def test_language_edges(spark, edge, none):
    out = L.identify(edge).collect()
    assert len(out) == len(EDGE)
    for r in out:
        if r.doc_id in (2, 3, 4, 11):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert L.identify(none).count() == 0
    unlabelled = spark.createDataFrame([(1, "words here", None)], "doc_id BIGINT, text STRING, lang STRING")
    assert [(r.lang_pred, r.score) for r in L.identify(unlabelled).collect()] == [("und", 0.0)]


def test_rows_of_one_doc_id_are_one_candidate(spark, monkeypatch):
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    rows = [(one, f"the text number {i} of one document", "en") for i in range(3000)] + [
        (i, "ein paar Worte", f"l{i}") for i in range(20, 40)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING").repartition(4)
    seen = []
    monkeypatch.setattr(L, "Model", lambda samples, *a: seen.append(samples))
    L.fit(df)
    L.fit(df, max_langs=3)
    assert len(seen[0]["en"]) <= L.SAMPLE_ROWS and sum(map(len, seen[0].values())) <= 64 + 20
    assert len(seen[1]) == 3 and "en" in seen[1]


def test_kept_columns_give_way_to_results(spark, edge):
    out = L.predict(edge, L.fit(edge), "doc_id", "lang_pred", "score", "h")
    assert out.columns == ["doc_id", "h", "lang_pred", "score", "n_letters"]


def test_a_kept_text_goes_to_python_once(spark):
    rows = [(i, f"{i} the quick brown fox " * 9000) for i in range(8)] + [(8, None), (9, "")]  # several passes a batch
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)
    model = L.Model({"en": ["the quick brown fox"], "de": ["der schnelle braune fuchs"]})
    found = L.predict(df, model, "doc_id", "text")
    assert "__text" not in found._jdf.queryExecution().toString()
    assert [(x.doc_id, x.text) for x in found.collect()] == rows
    other = L.predict(df.withColumnRenamed("text", "t"), model, "doc_id", text="t")
    columns = ["doc_id", "lang_pred", "score", "n_letters"]
    assert found.select(columns).collect() == other.collect()


def test_labels_are_no_inputs_of_a_prediction(spark, docs):
    from pyspark.sql import functions as F
    model = L.fit(docs)
    a = L.predict(docs, model, "doc_id").collect()
    b = L.predict(docs.withColumn("lang", F.lit("zz")), model, "doc_id").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


pytestmark = pytest.mark.filterwarnings("ignore")
