"""Token ids as binary shards, compressed by a Re-Pair grammar.

``write_shards`` puts the documents into ascending doc_id order (range
partitions), encodes whole texts, ends each with id 0 and cuts the stream at
document ends into shards of about ``shard_tokens`` ids. Every shard is compressed by
Re-Pair: the pair of neighbouring symbols that occurs most often is replaced by a
nonterminal wherever it stands, from left to right, and so on until no pair occurs
``min_count`` = 2 times. Counts are exact and follow each replacement. Pairs that never
touch each other have no influence on one another, so a batch replaces them together, as
one after the other would, if they have the same count or if no pair that waits or comes
into being occurs more often; of those that touch, the more frequent one is taken, and one
is drawn among equals. Pairs never cross a document's end, so each document is a run of
symbols of its own.

File format: Parquet, one row per shard with little-endian binary columns:
``doc_ids`` (int64), ``doc_null`` (uint8), ``doc_symbols`` and ``doc_tokens``
(int64 by document), ``rules`` (uint32 pairs; rule i is the symbol vocab + i),
``expansion`` (uint32: ids that each rule stands for) and ``symbols`` (uint16 if
all symbols fit, else uint32). ``part`` and ``seq`` order the shards. Expansion
lengths give random access: ``read_tokens`` decodes only the symbols that cover
the ids asked for.

Defined results: a null or empty text is the single id 0; a null doc_id comes
first; repeated rows are written as often as they occur (ties in doc_id keep any
order); an empty table gives no shard and no row; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, Window

from .common import scratch_path, utf8
from .tokens import default_tokenizer, encoder

SHARD_TOKENS, MIN_COUNT = 1 << 18, 2
#: Pairs looked at together though some are less frequent, where fewer are equally so and occur at least so often.
FEW, OFTEN = 40, 60
END_ID = 0

SHARD = ("part INT, seq INT, vocab INT, n_docs BIGINT, n_tokens BIGINT, width INT, doc_ids BINARY, doc_null BINARY, "
         "doc_symbols BINARY, doc_tokens BINARY, rules BINARY, expansion BINARY, symbols BINARY")
SHARD_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("vocab", pa.int32()), ("n_docs", pa.int64()),
                         ("n_tokens", pa.int64()), ("width", pa.int32())]
                        + [(c, pa.binary()) for c in ("doc_ids", "doc_null", "doc_symbols", "doc_tokens", "rules",
                                                      "expansion", "symbols")])


class Pairs:
    """The pairs of a sequence that occur ``least`` times or more (at least twice), with their places and exact counts.

    A pair's number never changes; its places are a slice of ``pool`` in ascending order, of which those
    whose ``pair`` still is the number are its occurrences. ``live`` counts them (its last slot takes what is
    counted for -1, no pair); ``bound`` is less where occurrences overlap (a run of one symbol). No count ever
    grows, so ``high``, the pairs that had ``floor`` occurrences or more when they were listed, has all that do now."""

    def __init__(self, seq: np.ndarray, last: np.ndarray, vocab: int, least: int = 2):
        n = len(seq)
        # bits of a symbol (a replacement takes a place, so there are fewer than n new ones) and of a place
        self.wide, self.place = (max(vocab, int(seq.max(initial=0)) + 1) + n).bit_length(), (n + 1).bit_length()
        # side by side, since a replacement asks for all of them at neighbouring places
        self.sym, self.next, self.prev, self.pair = np.empty((n + 1, 4), np.int32).T
        self.sym[:n], self.sym[n] = seq, -1
        self.last = np.append(last, True)  # the place n stands before the first and after the last symbol
        self.next[:], self.prev[:] = np.arange(1, n + 2), np.arange(-1, n)
        self.next[n] = self.prev[0] = n
        self.pair[:] = -1
        self.n = 0
        self.least = max(least, 2)
        self.of = np.zeros((2, 1024), np.int64)
        self.start, self.size, self.live, self.bound = (np.zeros(1024, np.int64) for _ in range(4))
        self.pool, self.used = np.zeros(max(n, 1), np.int32), 0
        self.high, self.floor = np.zeros(0, np.int64), 1 << 62
        at = np.flatnonzero(~last)
        self.add(at, seq[at], seq[at + 1])

    def add(self, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        """Number the pairs (left, right) that start at ``at`` (all occurrences of these pairs are there)."""
        if len(at) < self.least:
            return
        wide, place = self.wide, self.place
        if 2 * wide + place < 64:  # pair and place in one number
            key = left.astype(np.int64)
            key <<= wide
            key |= right
            key <<= place
            key |= at
            key.sort()
            at = key & ((1 << place) - 1)
            key >>= place
        else:
            order = np.lexsort((at, right, left))
            key, wide, at = left[order].astype(np.int64) << 32 | right[order], 32, at[order]
        edge = (key[1:] != key[:-1]).nonzero()[0]
        first = np.zeros(len(edge) + 2, np.int64)
        first[1:-1], first[-1] = edge + 1, len(key)
        size = first[1:] - first[:-1]
        several = (size >= self.least).nonzero()[0]
        if not len(several):
            return
        first, size = first[several], size[several]
        ends = size.cumsum()
        a, b, n = self.n, self.n + len(first), int(ends[-1])
        while b >= len(self.live):
            self.of = np.concatenate((self.of, np.zeros_like(self.of)), 1)
            self.start, self.size, self.live, self.bound = (np.concatenate((x, np.zeros_like(x))) for x in (
                self.start, self.size, self.live, self.bound))
        while self.used + n > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        start = ends - size
        places = at[np.arange(n) + np.repeat(first - start, size)]
        self.pool[self.used: self.used + n] = places
        self.pair[places] = np.repeat(np.arange(a, b), size)
        key = key[first]
        self.of[0, a:b], self.of[1, a:b] = key >> wide, key & ((1 << wide) - 1)
        self.start[a:b], self.size[a:b] = self.used + start, size
        self.live[a:b] = self.bound[a:b] = size
        self.n, self.used = b, self.used + n
        high = (size >= self.floor).nonzero()[0]
        if len(high):
            self.high = np.concatenate((self.high, a + high))

    def most(self) -> tuple[int, np.ndarray]:
        """(count, pairs) of the pairs that occur most often; 0 if none occurs ``least`` times."""
        while True:
            self.count = count = np.minimum(self.live[self.high], self.bound[self.high])
            most = int(count.max(initial=0))
            if most >= self.floor:
                return most, self.high[count == most]
            if self.floor <= self.least:
                return 0, self.high[:0]
            count = np.minimum(self.live[: self.n], self.bound[: self.n])
            self.floor = max(self.least, int(count.max(initial=0)) * 7 // 8)
            self.high = np.flatnonzero(count >= self.floor)

    def following(self) -> tuple[np.ndarray, np.ndarray]:
        """(counts, pairs) of the FEW most frequent pairs that ``most`` has just counted, in the order of their counts."""
        found = (self.count >= self.floor).nonzero()[0]
        found = found[np.argsort(-self.count[found], kind="stable")[:FEW]]
        return self.count[found], self.high[found]

    def beside(self, at: np.ndarray, k: np.ndarray, n: int) -> np.ndarray:
        """By index k < n: no pair that replacing its occurrences ``at`` makes occurs more often than this."""
        k = k * 64  # neighbours are told apart by six bits; those over a document's end count too
        left, right = self.sym[self.prev[at]], self.sym[self.next[self.next[at]]]
        most = [np.bincount(k + (x & 63), minlength=n * 64).reshape(n, 64).max(1) for x in (left, right)]
        return np.maximum(*most)

    def occurrences(self, ids: np.ndarray):
        """(places, index in ``ids``) of the occurrences that don't overlap, from left to right."""
        if len(ids) == 1:
            i = int(ids[0])
            at = self.pool[self.start[i]: self.start[i] + self.size[i]]
            at = at[self.pair[at] == i]
            k = np.zeros(len(at), np.int64)
            same = self.of[0, i] == self.of[1, i]
        else:
            size = self.size[ids]
            ends = size.cumsum()
            k = np.repeat(np.arange(len(ids)), size)
            at = self.pool[np.arange(len(k)) + (self.start[ids] - (ends - size))[k]]
            here = (self.pair[at] == ids[k]).nonzero()[0]
            at, k = at[here], k[here]
            same = (self.of[0, ids] == self.of[1, ids]).any()
        if same and len(at):
            after = np.append(False, (self.next[at[:-1]] == at[1:]) & (k[1:] == k[:-1]))
            run = np.maximum.accumulate(np.where(after, 0, np.arange(len(at))))
            even = (np.arange(len(at)) - run) % 2 == 0
            at, k = at[even], k[even]
        return at.astype(np.int64), k

    def replace(self, ids: np.ndarray, count: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> None:
        """Put ``symbol`` (all new) in the place of the pairs ``ids`` that start at ``at``, ``count`` times each."""
        gone, before = self.next[at].astype(np.int64), self.prev[at].astype(np.int64)
        self.live[ids] -= count
        self.pair[at] = -1
        for places in (gone, before):  # a place of ``before`` can be one of ``gone``
            np.subtract.at(self.live, self.pair[places].astype(np.int64), 1)
            self.pair[places] = -1
        ended, after = self.last[gone], self.next[gone].astype(np.int64)
        self.sym[at], self.sym[gone] = symbol, -1
        self.last[at], self.next[at] = ended, after
        self.prev[after] = at
        left = self.sym[before]
        one, two = ((left >= 0) & ~self.last[before]).nonzero()[0], (~ended).nonzero()[0]  # else it is in ``at``
        self.add(np.concatenate((before[one], at[two])), np.concatenate((left[one], symbol[two])),
                 np.concatenate((symbol[one], self.sym[after[two]])))


def compress(seq: np.ndarray, per_doc: np.ndarray, vocab: int, min_count: int = MIN_COUNT, rounds: int | None = None):
    """(symbols, symbols by document, rules) of a sequence of ids; ``rounds`` ends it after so many batches."""
    last = np.zeros(len(seq), bool)
    last[np.cumsum(per_doc[per_doc > 0]) - 1] = True
    pairs = Pairs(seq, last, vocab, min_count)
    rules, n = [np.zeros((0, 2), np.int64)], 0
    mine = np.zeros(0, np.int64)  # by pair: its index in the batch
    while rounds is None or rounds > 0:
        most, ids = pairs.most()
        if not most:
            break
        several = len(ids) < FEW and most >= OFTEN
        if several:
            count, ids = pairs.following()
        else:
            count = np.full(len(ids), most)
        at, k = pairs.occurrences(ids)
        found = np.bincount(k, minlength=len(ids))
        full, least = found == count, 0
        if not full.all():  # occurrences that overlap: the pair waits for its own count
            pairs.bound[ids[~full]] = found[~full]
            least = int(found[~full].max())
            at, k = at[full[k]], k[full[k]]
        if len(ids) > 1:
            # of pairs that touch each other the more frequent one is taken or else one is drawn, the other is counted anew
            drawn = (ids * 0x9E3779B1 & 0xFFFFFFFF) << 31 | ids
            if several:
                drawn = np.lexsort((drawn, -count)).argsort()
            if len(mine) < len(pairs.live):
                mine = np.full(len(pairs.live), -1)
            mine[ids] = np.where(full, np.arange(len(ids)), -1)
            other = mine[pairs.pair[pairs.next[at]]]
            mine[ids] = -1
            touch = ((other >= 0) & (other != k)).nonzero()[0]
            x, y = k[touch], other[touch]
            waits = drawn[x] > drawn[y]
            alone = full.copy()
            alone[np.where(waits, x, y)] = False
            if several:
                # a pair that is taken occurs as often as any that waits still does then, and as any new one
                lost = alone[np.where(waits, y, x)]
                lost = np.maximum(np.bincount(x[lost & waits], minlength=len(ids)),
                                  np.bincount(y[lost & ~waits], minlength=len(ids)))
                lost[pairs.of[0, ids] == pairs.of[1, ids]] = 0  # others of its run can take their place
                least = max(least, int((count - lost)[full & ~alone].max(initial=0)))
                alone &= count >= least
                at, k = at[alone[k]], k[alone[k]]
                new = pairs.beside(at, k, len(ids))
                order = np.argsort(drawn)
                short = count[order[1:]] < np.maximum.accumulate(new[order])[:-1]
                alone[order[1:][short]] = False
            full = alone
            at, k = at[full[k]], k[full[k]]
        if not len(at):
            continue
        ids, count = ids[full], count[full]
        symbol = (vocab + n + full.cumsum() - 1)[k]
        rules.append(pairs.of[:, ids].T)
        pairs.replace(ids, count, at, symbol)
        n += len(ids)
        if rounds is not None:
            rounds -= 1
    stay = np.flatnonzero(pairs.sym[:-1] >= 0)
    ends = np.flatnonzero(pairs.last[stay]) + 1
    by_doc = np.zeros(len(per_doc), np.int64)
    by_doc[per_doc > 0] = np.diff(ends, prepend=0)
    return pairs.sym[stay], by_doc, np.concatenate(rules)


def expansion_lengths(rules: np.ndarray, vocab: int) -> np.ndarray:
    """ids by rule; a rule's parts are ids or earlier rules of the list."""
    n = np.zeros(len(rules), np.int64)
    open_ = np.arange(len(rules))
    while len(open_):
        part = rules[open_]
        size = np.where(part < vocab, 1, n[np.maximum(part - vocab, 0)] if len(n) else 0)
        done = (size > 0).all(1)
        n[open_[done]] = size[done].sum(1)
        open_ = open_[~done]
    return n


def expand(symbols: np.ndarray, rules: np.ndarray, vocab: int, expansion: np.ndarray | None = None) -> np.ndarray:
    """The ids that the symbols stand for; ``expansion`` spares counting the rules' lengths."""
    expansion = expansion_lengths(rules, vocab) if expansion is None else expansion
    length = np.concatenate((np.ones(vocab, np.int64), expansion))
    symbols = symbols.astype(np.int64)
    ends = np.cumsum(length[symbols])
    at = ends - length[symbols]
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    while len(symbols):
        out[at] = symbols  # a rule gives way to its first part
        big = np.flatnonzero(symbols >= vocab)
        pair, at = rules[symbols[big] - vocab], at[big]
        symbols, at = pair.T.ravel(), np.concatenate((at, at + length[pair[:, 0]]))
    return out


class Shard:
    """A shard row, opened for reading."""

    def __init__(self, row: dict):
        def of(c, t):
            return np.frombuffer(row[c], t)

        self.vocab = row["vocab"]
        self.doc_ids, self.doc_null = of("doc_ids", "<i8"), of("doc_null", "u1")
        self.doc_symbols, self.doc_tokens = of("doc_symbols", "<i8"), of("doc_tokens", "<i8")
        self.rules = of("rules", "<u4").reshape(-1, 2).astype(np.int64)
        self.expansion = of("expansion", "<u4").astype(np.int64)
        self.symbols = of("symbols", "<u2" if row["width"] == 2 else "<u4")

    def read_tokens(self, start: int, n: int) -> np.ndarray:
        """ids [start, start + n) of the shard, from the symbols that cover them alone."""
        s = self.symbols.astype(np.int64)
        size = np.where(s < self.vocab, 1, self.expansion[np.maximum(s - self.vocab, 0)] if len(self.expansion) else 1)
        ends = np.cumsum(size)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + n, "left") + 1
        skip = start - (ends[a] - size[a]) if a < len(s) else 0
        return expand(s[a:b], self.rules, self.vocab, self.expansion)[skip: skip + n]

    def documents(self) -> Iterator[tuple]:
        """(doc_id or None, first id in the shard, ids) by document."""
        ids = expand(self.symbols, self.rules, self.vocab, self.expansion).astype("<u4")
        end = np.cumsum(self.doc_tokens)
        for d, null, e, n in zip(self.doc_ids.tolist(), self.doc_null.tolist(), end.tolist(), self.doc_tokens.tolist()):
            yield None if null else d, e - n, ids[e - n: e]


def _shard(part, seq, vocab, doc_ids, doc_null, ids, per_doc, min_count, rounds) -> dict:
    symbols, by_doc, rules = compress(ids, per_doc, vocab, min_count, rounds)
    width = 2 if vocab + len(rules) <= 1 << 16 else 4
    return {"part": part, "seq": seq, "vocab": vocab, "n_docs": len(doc_ids), "n_tokens": len(ids), "width": width,
            "doc_ids": doc_ids.astype("<i8").tobytes(), "doc_null": doc_null.astype("u1").tobytes(),
            "doc_symbols": by_doc.astype("<i8").tobytes(), "doc_tokens": per_doc.astype("<i8").tobytes(),
            "rules": rules.astype("<u4").tobytes(), "expansion": expansion_lengths(rules, vocab).astype("<u4").tobytes(),
            "symbols": symbols.astype("<u2" if width == 2 else "<u4").tobytes()}


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS,
                 min_count: int = MIN_COUNT, rounds: int | None = None) -> None:
    """Write ``docs`` (doc_id, text) as shards below ``path``."""
    tokenizer = tokenizer or default_tokenizer()

    def run(batches):
        enc, seq, part = encoder(tokenizer), 0, TaskContext.get().partitionId()
        vocab = enc.lib.get_vocab_size()
        held, size = [], 0

        def out():
            ids, null, flat, per = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_pylist([_shard(part, seq, vocab, ids, null, flat, per, min_count, rounds)],
                                              SHARD_ARROW)

        for batch in batches:
            buf, off = utf8(batch.column("text"))
            doc = batch.column("doc_id")
            null = np.asarray(doc.is_null())
            ids = np.asarray(doc.fill_null(0)).astype(np.int64)
            a = 0
            while a < len(ids):
                b = max(a + 1, int(np.searchsorted(off, off[a] + (2 << 20), "right")) - 1)
                flat, at = enc.ids(buf[off[a]: off[b]], off[a: b + 1] - off[a])
                per = np.diff(at) + 1
                ended = np.zeros(len(flat) + b - a, np.uint32)
                stay = np.ones(len(ended), bool)
                stay[np.cumsum(per) - 1] = False
                ended[stay] = flat
                held.append((ids[a:b], null[a:b], ended, per))
                size += len(ended)
                if size >= shard_tokens:
                    yield out()
                    held, size, seq = [], 0, seq + 1
                a = b
        if held:
            yield out()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, SHARD).write.parquet(path))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the shards below ``path``."""
    shards = spark.read.schema(SHARD).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [(row["part"], row["seq"], d, s, len(x), zlib.crc32(x.tobytes()))
                         for d, s, x in Shard(row).documents()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in found], t) for i, t in
                     enumerate((pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                    ["part", "seq", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = shards.mapInArrow(run, "part INT, seq INT, doc_id BIGINT, at BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    sizes = shards.select("part", "seq", "n_tokens")
    # one row per range partition; the shards of a partition are ordered within it
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    seqs = sizes.select("part", "seq", (F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq"))
                                        - F.col("n_tokens")).alias("seq_start"))
    starts = seqs.join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("base"))
    return rows.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_shards(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the shards and read every document back from them."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "repair")
    write_shards(docs, path, **options)
    return read_documents(spark, path)
