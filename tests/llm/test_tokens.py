import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from clickflow.llm import op3_repair as R, op6_packing as P
from clickflow.llm.common import scratch_path, span_hashes, utf8
from clickflow.llm.tokens import Encoder, default_tokenizer, encoder

from .conftest import EDGE


def encode(text, end):
    return encoder(default_tokenizer()).lib.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_encoder_equals_library(docs):
    texts = [r.text for r in docs.select("text").collect()] + [t for _, t, *_ in EDGE]
    texts += ["a  b", "a \n b", "　 x y", " lead trail ", "it's  the' s", "x \u0085 y", "<|endoftext|> a <|endoftext|>",
              "a b\x1c c \x1f d", "  ", "  a  b", "é à   ü"]
    enc = encoder(default_tokenizer())
    for _ in range(2):  # from the library, then from the cache
        ids, at = enc.ids(*utf8(pa.array(texts, pa.string())))
        for i, t in enumerate(texts):
            assert ids[at[i]: at[i + 1]].tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n_docs in (1, 7, 60):
        per = rng.integers(1, 400, n_docs)
        ids = rng.choice([5, 6, 7, 7, 7, 900], int(per.sum()))
        sym, by_doc, rules = R.compress(ids, per, 1000, 4, 6)
        assert len(sym) < len(ids) and by_doc.sum() == len(sym)
        assert (R.expand(sym, rules, 1000) == ids).all()
        size = R.expansion_lengths(rules, 1000)
        assert [len(R.expand(np.array([1000 + i]), rules, 1000)) for i in range(len(rules))] == size.tolist()
        row = R._shard(0, 0, 1000, np.arange(n_docs), np.zeros(n_docs, bool), ids, per, 4, 6)
        shard = R.Shard(row)
        for _ in range(20):
            a = int(rng.integers(0, len(ids)))
            n = int(rng.integers(0, len(ids) - a + 1))
            assert shard.read_tokens(a, n).tolist() == ids[a: a + n].tolist()


def replayed(docs, rules, vocab):
    """The documents after each rule, and the exact counts of their pairs before it and at the end."""
    def counts():
        found = {}
        for d in docs:
            until = {}  # occurrences that overlap count once
            for i, p in enumerate(zip(d, d[1:])):
                if until.get(p, 0) <= i:
                    found[p] = found.get(p, 0) + 1
                    until[p] = i + 2
        return found

    seen = []
    for i, (x, y) in enumerate(rules):
        seen.append(counts())
        out = []
        for d in docs:
            new, j = [], 0
            while j < len(d):
                hit = d[j: j + 2] == [x, y]
                new.append(vocab + i if hit else d[j])
                j += 2 if hit else 1
            out.append(new)
        docs = out
    return docs, [*seen, counts()]


def test_rules_are_the_most_frequent_pairs_until_none_repeats():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 9, 70)
    cases = [[rng.integers(0, k, int(rng.integers(0, 50))) for _ in range(6)] for k in (1, 2, 3, 6) for _ in range(8)]
    cases += [[passage] * 40, [np.concatenate((passage[i:], passage[:i])) for i in range(0, 70, 7)], [np.zeros(700, int)]]
    for docs in cases:
        per = np.array([len(d) for d in docs])
        sym, by_doc, rules = R.compress(np.concatenate(docs), per, 10)
        left, counts = replayed([d.tolist() for d in docs], rules.tolist(), 10)
        for (x, y), found in zip(rules.tolist(), counts):
            assert found[x, y] == max(found.values()) >= 2
        assert max(counts[-1].values(), default=0) < 2
        assert [x for d in left for x in d] == sym.tolist() and [len(d) for d in left] == by_doc.tolist()
        assert R.expand(sym, rules, 10).tolist() == [x for d in docs for x in d.tolist()]


def test_most_frequent_pairs_equal_a_count_of_all(monkeypatch):
    listed, most = [], R.Pairs.most

    def counted(pairs):
        count, ids = most(pairs)
        every = np.minimum(pairs.live[: pairs.n], pairs.bound[: pairs.n])
        best = int(every.max(initial=0))
        assert count == (best if best >= pairs.least else 0)
        if count:
            assert ids.tolist() == np.flatnonzero(every == best).tolist()
        listed.append((len(pairs.high), pairs.n))
        for i in range(pairs.n):  # counts are exact
            at = pairs.pool[pairs.start[i]: pairs.start[i] + pairs.size[i]]
            assert pairs.live[i] == (pairs.pair[at] == i).sum()
        return count, ids

    monkeypatch.setattr(R.Pairs, "most", counted)
    rng = np.random.default_rng(5)
    for letters, least in ((2, 2), (5, 2), (40, 2), (40, 4)):
        per = rng.integers(0, 60, 40)
        seq = (rng.zipf(1.5, int(per.sum())) % letters).astype(np.uint32)
        symbols, by_doc, rules = R.compress(seq, per, 50, least)
        assert (R.expand(symbols, rules, 50) == seq).all() and by_doc.sum() == len(symbols)
    assert any(0 < a < b // 4 for a, b in listed)  # few are looked at


def test_pairs_of_several_counts_in_one_batch_are_the_most_frequent_in_turn(monkeypatch):
    monkeypatch.setattr(R, "OFTEN", 2)
    batches, replace = [], R.Pairs.replace

    def counted(pairs, ids, count, at, symbol):
        batches.append(len(set(np.asarray(count).tolist())))
        replace(pairs, ids, count, at, symbol)

    monkeypatch.setattr(R.Pairs, "replace", counted)
    rng = np.random.default_rng(6)
    for letters in (1, 2, 3, 15, 40) * 8:
        docs = [rng.zipf(1.5, int(rng.integers(0, 90))) % letters for _ in range(7)]
        docs += [np.concatenate((docs[0], docs[1], docs[0]))] * int(rng.integers(0, 3))
        sym, by_doc, rules = R.compress(np.concatenate(docs), np.array([len(d) for d in docs]), 50)
        left, counts = replayed([d.tolist() for d in docs], rules.tolist(), 50)
        for (x, y), found in zip(rules.tolist(), counts):
            assert found[x, y] == max(found.values()) >= 2
        assert max(counts[-1].values(), default=0) < 2
        assert [x for d in left for x in d] == sym.tolist() and [len(d) for d in left] == by_doc.tolist()
    assert max(batches) > 1


def test_a_word_is_encoded_once_whatever_follows():
    enc = Encoder(default_tokenizer())
    sent, lib = [], enc.lib

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return lib.encode_batch_fast(texts, **options)

    words = ["".join(random.Random(i).choices("abcdefghéü", k=9)) for i in range(200)]
    texts = [f"a {w}{end}b" for end in (" ", ", ", ".\n", "!? ", "\n", "7 ", "'s ") for w in words]
    enc.lib = Counting()
    ids, at = enc.ids(*utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[at[i]: at[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert sum(map(len, sent)) < 2 * sum(len(w) + 1 for w in words)


def test_a_kept_encoder_holds_little_and_asks_the_library_in_short_runs():
    """Spark keeps workers, and so their encoders, beside the heap of the executor while later stages run."""
    enc = Encoder(default_tokenizer())
    sent, lib = [], enc.lib

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return lib.encode_batch_fast(texts, **options)

    texts = [" ".join("".join(random.Random(99 * i + k).choices("abcdefghéü", k=9)) for k in range(99)) for i in range(400)]
    enc.lib = Counting()
    for _ in range(2):
        ids, at = enc.ids(*utf8(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[at[i]: at[i + 1]].tolist() == lib.encode(t, add_special_tokens=False).ids
    assert max(len(t.encode()) for t in sent) < 1 << 17 < sum(len(t.encode()) for t in sent)
    held = sum(x.nbytes for x in vars(enc).values() if isinstance(x, np.ndarray))
    assert held < 24_000_000


def test_a_piece_that_lost_its_place_is_encoded_again(monkeypatch):
    from clickflow.llm import tokens
    monkeypatch.setattr(tokens, "SLOT_BITS", 4)
    monkeypatch.setattr(tokens, "POOL", 2000)
    enc = Encoder(default_tokenizer())
    for k in range(30):
        texts = [f"{i * j} word{i} of {j}, é{j}" for i in range(k, k + 20) for j in range(3)]
        ids, at = enc.ids(*utf8(pa.array(texts)))
        for i, t in enumerate(texts):
            assert ids[at[i]: at[i + 1]].tolist() == enc.lib.encode(t, add_special_tokens=False).ids
    assert enc.taken <= 17


def test_pieces_of_odd_texts_equal_library():
    rng = random.Random(2)
    parts = ["a", "B", "é", "×", "÷", "ß", "ǃ", "Ȁ", "ɐ", "ʰ", "α", "Ж", "ا", "\u0301", "5", "12", "٣", "²", "½", ".", ",", "'",
             "'s", "'re", "'LL", '"', "!?", "\n", "\n\n", "\r\n", "\t", " ", "  ", " \n", "\n ", "\xa0", "\u2003", "中文", "😀",
             "<|endoftext|>", "#", "the", " and", "\x00", "\x7f", "\x85", "\x0b", "\x1c", "ª", "µ", "\u200b", "'ſ"]
    texts = [None, ""] + ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(4000)]
    enc = Encoder(default_tokenizer())
    ids, at = enc.ids(*utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[at[i]: at[i + 1]].tolist() == enc.lib.encode(t or "", add_special_tokens=False).ids


def test_hashes_of_spans_that_follow_one_another_equal_those_of_each_alone():
    rng = np.random.default_rng(7)
    buf = rng.integers(0, 256, 5000).astype(np.uint8)
    first = np.unique(np.append(0, rng.integers(0, 5000, 700)))
    size = np.diff(np.append(first, 5000))
    alone = [int(span_hashes(np.append(buf[a: a + n], np.uint8(0)), np.array([0]), np.array([n]))[0])
             for a, n in zip(first.tolist(), size.tolist())]
    assert span_hashes(buf, first, size).tolist() == alone


def test_shards_equal_brute_force(spark, docs):
    out = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in R.token_shards(docs, shard_tokens=20_000).collect()}
    at, want = 0, {}
    for d, t in sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()):
        ids = encode(t, 0)
        want[d] = (at, len(ids), crc(ids))
        at += len(ids)
    assert out == want


def test_shard_edges(spark, edge, none):
    path = scratch_path(spark, "t")
    rows = R.token_shards(edge, path).collect()
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == sorted((len(x), crc(x)) for x in (encode(t, 0) for _, t, *_ in EDGE))
    rows.sort(key=lambda r: r.start)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    assert [r.doc_id for r in rows] == sorted((d for d, *_ in EDGE), key=lambda d: (d is not None, d or 0))
    assert R.token_shards(none).count() == 0


def check_packing(rows, texts, window):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for d, t in texts.items():
        ids, at = encode(t, 1), 0
        for r in sorted(by_doc[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == crc(ids[at: at + r.length])
            at += r.length
        assert at == len(ids)
    for piece in by_seq.values():
        at = 0
        for r in sorted(piece, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return by_seq


def test_packing_covers_each_id_once(spark, docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for size in (P.SHARD_BYTES, 60_000):
        seqs = check_packing(P.pack(docs, shard_bytes=size).collect(), texts, 2048)
        full = sum(sum(r.length for r in s) == 2048 for s in seqs.values())
        assert full >= len(seqs) - (1 if size == P.SHARD_BYTES else 30)


def test_packing_edges(spark, edge, none):
    texts = [e for e in EDGE if e[0] not in (None, 9)]
    rows = P.pack(edge).collect()
    by_doc = {}
    for r in sorted(rows, key=lambda r: r.start):
        by_doc.setdefault(r.doc_id, []).append(r)
    for d, t, *_ in texts:
        ids = encode(t, 1)
        assert [r.ids_crc32 for r in by_doc[d]] == [crc(ids[r.start: r.start + r.length]) for r in by_doc[d]]
    assert sum(r.length for r in rows) == sum(len(encode(t, 1)) for _, t, *_ in EDGE)
    assert P.pack(none).count() == 0


def test_neighbours_are_bm25_ranked():
    docs = ["apple pie recipe", "apple pie crust", "boat sail wind", "wind boat storm sail", "apple tree"]
    from clickflow.llm.common import words
    buf, off = utf8(pa.array(docs))
    row, _, _, h = words(buf, off)
    index = P.Bm25(row, h, len(docs))
    free = np.ones(5, bool)
    free[0] = False
    assert index.neighbours(0, free).tolist() == [1, 4]
    free[:] = True
    free[2] = False
    assert index.neighbours(2, free).tolist() == [3]


def test_neighbours_equal_brute_force():
    """Every document that shares a word is ranked by all words of the seed, however common they are."""
    from clickflow.llm.common import words
    rng = random.Random(8)
    rare = [f"rare{i}" for i in range(12)]
    docs = [" ".join(rare + ["plain", "text"]), " ".join(rare), "plain", "text plain plain", "other", "text other"]
    docs += [" ".join(rng.choice([f"w{int(40 * rng.random() ** 2)}" for _ in range(9)]) for _ in range(rng.randrange(1, 60)))
             for _ in range(80)]
    split = [d.split() for d in docs]
    n, mean = len(docs), sum(map(len, split)) / len(docs)
    df = {}
    for d in split:
        for w in set(d):
            df[w] = df.get(w, 0) + 1

    def score(a, b):
        total = 0
        for w in set(split[a]) & set(split[b]):
            f = split[b].count(w)
            total += np.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * f * (P.K1 + 1) / (
                f + P.K1 * (1 - P.B + P.B * len(split[b]) / mean))
        return total

    buf, off = utf8(pa.array(docs))
    row, _, _, h = words(buf, off)
    index = P.Bm25(row, h, n)
    for a in range(n):
        free = np.array([b != a and rng.random() < 0.9 for b in range(n)])
        want = {b: score(a, b) for b in np.flatnonzero(free).tolist()}
        got = index.neighbours(a, free).tolist()
        assert sorted(got) == [b for b in want if want[b] > 0]
        assert np.allclose([want[b] for b in got], sorted((v for v in want.values() if v > 0), reverse=True))
        few = index.neighbours(a, free, 3).tolist()
        assert few == got[: len(few)] and len(few) >= min(3, len(got))
    free = np.ones(n, bool)
    free[0] = False
    assert set(index.neighbours(0, free).tolist()) == {1, 2, 3, 5}


def test_all_neighbours_of_a_seed_follow_it():
    """A window takes the seed's neighbours to the last one, in their order, however many are ranked at a time."""
    from clickflow.llm.common import words
    docs = ["seed a b c", *["far off"] * 30, *["a b c"] * 40, *["c"] * 50]
    buf, off = utf8(pa.array(docs))
    row, _, _, h = words(buf, off)
    pieces = P.fill(P.Bm25(row, h, len(docs)), np.full(len(docs), 10), 1000)
    assert [d for d, *_ in pieces[:91]] == [0, *range(31, 121)]
    assert sorted(d for d, *_ in pieces if d) == list(range(1, len(docs)))


def test_related_documents_share_windows(spark):
    rng = random.Random(5)
    rows = []
    for i in range(200):
        topic = i % 10
        rows.append((i, " ".join(rng.choice([f"topic{topic}word{j}" for j in range(30)]) for _ in range(60))))
    out = P.pack(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)).collect()
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, set()).add(r.doc_id % 10)
    assert sum(map(len, seqs.values())) / len(seqs) < 2.5  # ten topics, windows of one or two
