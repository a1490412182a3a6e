"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are lower-cased and reduced to letters and digits with single
blanks between them. An item of m bytes has an edit budget k, ``error`` of m rounded
down. By the q-gram lemma a region within k edits of it shares at least
m + 1 - q - k * q q-grams with it, on diagonals (position in the text minus position
in the item) that differ by k at most. Short items whose budget leaves no such bound
(below 40 bytes, some) have an index of their own with shorter grams (``SHORT_Q``).

1. A bit table of the items' q-grams marks the positions of a text. By a pigeonhole
   bound, of the windows of the shortest item's length that a region of any item
   spans one at least is rich in marks; all marks within the longest item's reach of
   a rich window are kept, so nothing is lost, whatever items share an index.
2. Those marks are looked up and counted by item and diagonal band; bands
   are 2 (k + 1) wide and overlap by half, so some band holds all diagonals of a
   region within budget. Bands that meet the bound are retained. At most ``POSTINGS``
   hits are held at a time; what stays of them is one count per band.
3. A banded alignment of the item with the region verifies the edit distance.

The items are a stated query set: they pass through the driver in blocks of at
most ``block_chars`` characters, each broadcast and matched against all texts in
one pass without a shuffle. A lost executor costs the tasks it was working on.

Defined results: null and empty texts match nothing; items of fewer than q bytes
after reduction are no evidence and match nothing; a null doc_id or item_id passes
through; repeated rows and items are matched row by row; of equally close regions the
first counts; long texts are searched whole, one at a time; empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import give_back

Q, SHORT_Q, ERROR, BLOCK_CHARS, TABLE_BITS, POSTINGS = 10, 6, 0.08, 8_000_000, 22, 1 << 21

MATCH = "doc_id BIGINT, item_id BIGINT, start BIGINT, length BIGINT, distance BIGINT"

_REDUCE = np.full(256, 32, np.uint8)
for _c in range(256):
    if _c >= 0x80 or chr(_c).isalnum():
        _REDUCE[_c] = _c


def reduced(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the reduced texts."""
    data = [(t or "").lower().encode() for t in texts]
    off = np.concatenate(([0], np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))))
    buf = _REDUCE[np.frombuffer(b"".join(data), np.uint8)]
    first = np.zeros(len(buf) + 1, bool)
    first[off] = True
    blank = buf == 32
    stay = ~blank
    stay[1:] |= ~blank[:-1]
    stay &= ~(first[:-1] & blank)
    # a blank at a row's start belongs to the row before, if anything, and is dropped above
    kept = np.concatenate(([0], np.cumsum(stay)))
    return buf[stay], kept[off]


def gram_hashes(buf: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of the q bytes (q <= 16) from each position on."""
    n = max(len(buf) - q + 1, 0)
    pad = np.concatenate((buf, np.zeros(16, np.uint8)))
    view = np.ndarray((len(buf) + 8,), "<u8", pad, strides=(1,))
    if q < 8:
        x = (view[:n] & np.uint64((1 << (8 * q)) - 1)) * np.uint64(0x9E3779B97F4A7C15)
        return x ^ (x >> np.uint64(29))
    x = view[:n] * np.uint64(0x9E3779B97F4A7C15)
    x ^= (view[q - 8: q - 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(7)
    x *= np.uint64(0x165667B19E3779F9)
    return x ^ (x >> np.uint64(29))


def _bound(m: np.ndarray, k: np.ndarray, q: int) -> np.ndarray:
    return m + 1 - q - k * q


def _summed(row, item, band, hits, low, high) -> tuple:
    """One entry per row, item and band: its hits, lowest and highest diagonal."""
    order = np.lexsort((band, item, row))
    r, i, b = row[order], item[order], band[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (i[1:] != i[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(new)
    return (r[first], i[first], b[first], np.add.reduceat(hits[order], first),
            np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first))


class Items:
    """Index of one block of benchmark items: those whose budget leaves a bound for grams of ``q`` bytes,
    or with ``short`` the others, by grams of ``SHORT_Q`` bytes."""

    def __init__(self, ids: list, texts: list, q: int = Q, error: float = ERROR, short: bool = False):
        self.ids = ids
        buf, off = reduced(texts)
        self.text = [buf[a:b].tobytes().rstrip(b" ") for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
        self.m = np.array([len(t) for t in self.text], np.int64)
        self.k = (error * self.m).astype(np.int64)
        fits = _bound(self.m, self.k, q) > 0
        mine = (self.m >= q) & (~fits if short else fits)
        self.q = q = SHORT_Q if short else q
        self.bound = _bound(self.m, self.k, q)
        use = np.flatnonzero(mine & (self.bound > 0))
        grams, item, pos = [], [], []
        for i in use.tolist():
            g = gram_hashes(np.frombuffer(self.text[i], np.uint8), q)
            grams.append(g)
            item.append(np.full(len(g), i))
            pos.append(np.arange(len(g)))
        self.empty = not len(use)
        if self.empty:
            return
        grams, item, pos = map(np.concatenate, (grams, item, pos))
        order = np.argsort(grams, kind="stable")
        self.grams, first = np.unique(grams[order], return_index=True)
        self.ptr = np.append(first, len(grams))
        self.item, self.pos = item[order], pos[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.grams >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
        reach = self.m[use] + self.k[use]  # a region's grams start within so many positions
        self.width, self.reach = int(reach.min()), int(reach.max())
        self.least = max(1, int((self.bound[use] // -(-reach // self.width)).min()))

    def marks(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes of all grams): positions of item q-grams in stretches that are rich enough for some item."""
        h = gram_hashes(buf, self.q)
        hit = self.table[(h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        at = np.flatnonzero(hit & self._within(off, len(hit)))
        if len(at) < self.least:
            return at[:0], h
        # marks that have least - 1 others within width on one side or the other
        close = np.flatnonzero(at[self.least - 1:] - at[: len(at) - self.least + 1] < self.width)
        edge = np.zeros(len(at) + 1, np.int64)
        np.add.at(edge, close, 1)
        np.add.at(edge, close + self.least, -1)
        rich = at[np.cumsum(edge[:-1]) > 0]
        if not len(rich):
            return rich, h
        # and all marks that a region around one of those may reach
        i = np.searchsorted(rich, at)
        after = rich[np.minimum(i, len(rich) - 1)] - at
        before = at - rich[np.maximum(i - 1, 0)]
        near = ((after >= 0) & (after <= self.reach)) | ((before >= 0) & (before <= self.reach))
        return at[near], h

    def _within(self, off, n):
        ok = np.ones(n, bool)  # no gram crosses a row's end
        for o in off[1:-1].tolist():
            ok[max(o - self.q + 1, 0): o] = False
        return ok

    def candidates(self, buf: np.ndarray, off: np.ndarray):
        """(row, item, lowest and highest diagonal of the marks) of bands that meet the bound."""
        at, h = self.marks(buf, off)
        at = at[at < len(h)]
        g = np.searchsorted(self.grams, h[at])
        g[g == len(self.grams)] = 0
        real = self.grams[g] == h[at]
        at, g = at[real], g[real]
        n = self.ptr[g + 1] - self.ptr[g]
        if not len(n):
            return np.zeros((0, 4), np.int64)
        shift_by = int(self.m.max())  # no diagonal lies below its negative
        held: list[list] = [[], []]
        ends = np.cumsum(n)
        a = 0
        while a < len(at):  # a slice of the marks with POSTINGS hits or so
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + POSTINGS, "right")))
            c, first = n[a:b], self.ptr[g[a:b]]
            where = np.repeat(first - (np.cumsum(c) - c), c) + np.arange(c.sum())
            pos = np.repeat(at[a:b], c)
            item, diagonal = self.item[where], pos - self.pos[where]
            row = np.searchsorted(off, pos, "right") - 1
            half = self.k[item] + 1
            for shift in (0, 1):  # bands [2 j half, 2 (j + 1) half) and those between
                band = (diagonal + shift_by + shift * half) // (2 * half)
                held[shift].append(_summed(row, item, band, np.ones(len(row), np.int64), diagonal, diagonal))
                if len(held[shift]) > 8:
                    held[shift] = [_summed(*map(np.concatenate, zip(*held[shift])))]
            a = b
        out = []
        for sums in held:
            r, i, _, hits, low_d, high_d = _summed(*map(np.concatenate, zip(*sums)))
            enough = hits >= self.bound[i]
            out.append(np.stack((r, i, low_d, high_d), 1)[enough])
        return np.unique(np.concatenate(out), axis=0)

    def verify(self, text: bytes, item: int, low: int, high: int):
        """(start, length, distance) of the region of ``text`` closest to the item between the diagonals
        ``low`` and ``high`` and k beyond, or None if the distance exceeds the budget."""
        word, k, m = self.text[item], int(self.k[item]), int(self.m[item])
        a, b = max(low - k, 0), min(high + k + m, len(text))
        part = text[a:b]
        found = part.find(word)
        if found >= 0:
            return a + found, m, 0
        if not k:
            return None
        return _aligned(word, part, low - k - a, high + k - a, k, a)


def _aligned(word: bytes, part: bytes, low: int, high: int, k: int, a: int):
    """Semi-global alignment of all of ``word`` inside ``part``, diagonals low to high only."""
    n, wide = len(part), high - low + 1
    far = k + 1
    text = np.frombuffer(part, np.uint8)
    j = low + np.arange(wide)  # end positions in part before any byte of the word
    ok = (j >= 0) & (j <= n)
    cost = np.where(ok, 0, far)
    start = np.where(ok, j, 0)
    idx = np.arange(wide)
    for i, c in enumerate(word):
        j = low + idx + i + 1  # after i + 1 bytes, on the diagonals low to high
        ok = (j >= 0) & (j <= n)
        here = text[np.clip(j - 1, 0, max(n - 1, 0))] if n else np.zeros(wide, np.uint8)
        step = np.where(j >= 1, cost + (here != c), far)
        up = np.append(cost[1:], far) + 1  # a byte of the word that the text lacks
        new = np.where(step <= up, step, up)
        begin = np.where(step <= up, start, np.append(start[1:], 0))
        new = np.where(ok, np.minimum(new, far), far)
        # bytes of the text that the word lacks: along the row, each costs one
        run = new - idx
        best = np.minimum.accumulate(run)
        src = np.maximum.accumulate(np.where(run == best, idx, 0))
        new, begin = np.minimum(best + idx, far), begin[src]
        cost, start = np.where(ok, new, far), begin
        if cost.min() > k:
            return None
    end = int(cost.argmin())
    return a + int(start[end]), low + end + len(word) - int(start[end]), int(cost[end])


def matches(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, start, length (bytes in the reduced text) and distance of every region of a row of
    ``docs`` (doc_id, text) within the edit budget of a row of ``benchmark`` (item_id, text); of several such
    regions for one item in a text the closest, then the first."""
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = spark.createDataFrame([], MATCH)
    for indexes in _blocks(benchmark, q, error, block_chars):
        found = found.union(text.mapInArrow(_matcher(spark.sparkContext.broadcast(indexes)), MATCH))
    return found


def free_rows(docs: DataFrame, benchmark: DataFrame, q: int = Q, error: float = ERROR,
              block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` (with a column text), whole and in place, in which no row of ``benchmark`` is
    matched; what the other columns hold, nulls and repeated rows included, doesn't matter."""
    for indexes in _blocks(benchmark, q, error, block_chars):
        docs = docs.mapInArrow(_filter(docs.sparkSession.sparkContext.broadcast(indexes)), docs.schema)
    return docs


def _blocks(benchmark: DataFrame, q: int, error: float, block_chars: int):
    """The indexes of each block of items."""
    ids, texts, size = [], [], 0

    def indexed():
        return [x for x in (Items(list(ids), list(texts), q, error, short) for short in (False, True)) if not x.empty]

    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1] or "")
        if size >= block_chars:
            if block := indexed():
                yield block
            ids, texts, size = [], [], 0
    if ids and (block := indexed()):
        yield block


def _passes(texts: list):
    """Runs [a, b) of about a megabyte of text."""
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size < 1 << 20):
            size += len(texts[b] or "")
            b += 1
        yield a, b
        a = b


def _filter(shared):
    def hits(texts: list, indexes: list) -> set[int]:
        buf, off = reduced(texts)
        found: set[int] = set()
        for index in indexes:
            for r, i, low, high in index.candidates(buf, off).tolist():
                if r not in found and index.verify(buf[off[r]: off[r + 1]].tobytes(), i, low - int(off[r]), high - int(off[r])):
                    found.add(r)
        return found

    def run(batches):
        indexes = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            stay = np.ones(len(texts), bool)
            for a, b in _passes(texts):
                stay[[a + r for r in hits(texts[a:b], indexes)]] = False
            yield batch.filter(pa.array(stay))
        give_back()

    return run


def _matcher(shared):
    def rows(doc_ids, texts, indexes):
        buf, off = reduced(texts)
        found = []
        for index in indexes:
            best = {}
            for r, i, low, high in index.candidates(buf, off).tolist():
                if best.get((r, i), (0, 0, 1))[2] == 0:
                    continue  # regions come from left to right: none is closer, or as close and further left
                text = buf[off[r]: off[r + 1]].tobytes()
                hit = index.verify(text, i, low - int(off[r]), high - int(off[r]))
                if hit and ((r, i) not in best or (hit[2], hit[0]) < (best[r, i][2], best[r, i][0])):
                    best[r, i] = hit
            found += [(doc_ids[r], index.ids[i], *hit) for (r, i), hit in sorted(best.items())]
        return found

    def run(batches):
        indexes = shared.value
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            found = []
            for a, b in _passes(texts):
                found += rows(doc_ids[a:b], texts[a:b], indexes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in range(5)],
                ["doc_id", "item_id", "start", "length", "distance"])
        give_back()

    return run
