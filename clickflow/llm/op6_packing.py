"""Sequence packing by lexical retrieval.

The rows of each scan partition are cut into shards of about ``shard_bytes`` of
text, and each shard gets an inverted BM25 index of its own over the lower-cased
words of the whole texts (counts, lengths and document frequencies are those of
the shard, as in any sharded index). Windows are filled greedily: the document
whose ids open a window is its seed; the unused neighbours that the index ranks
highest for all words of the seed follow until the window is full: every document
of the shard that shares a word with the seed is a candidate, with its whole BM25
score. The document that crosses the window's end is cut there, and its
rest opens, and is the seed of, the next window. If a seed has no unused
neighbour left, the next unused document in row order is taken. So only the last
window of a shard can be short; no id is padded before it.

No shuffle: a shard lives in one task, its size is bounded by ``shard_bytes``
(or one document), and a lost executor costs the shards it was working on.

Defined results: a null or empty text is the end id alone; a null doc_id passes
through; repeated rows are packed as often as they occur; equal scores are taken
in row order; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import chunks, give_back, utf8, words
from .tokens import default_tokenizer, encoder

WINDOW, END_ID, SHARD_BYTES, K1, B = 2048, 1, 8 << 20, 1.2, 0.75
#: Neighbours ranked at a time; the next ones follow when these are used.
AT_ONCE = 32

PIECE = ("doc_id BIGINT, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, "
         "offset BIGINT")


class Bm25:
    """Inverted index of one shard: postings by term with their BM25 weights, and each document's terms.

    Only terms of a single document are left out: nothing is found by them."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, n: int):
        self.n = n
        _, term = np.unique(terms, return_inverse=True)
        key, tf = np.unique(term.astype(np.int64) * max(n, 1) + rows, return_counts=True)
        term, doc = key // max(n, 1), key % max(n, 1)  # by term, then document
        df = np.bincount(term) if len(term) else np.zeros(0, np.int64)
        shared = df[term] > 1 if len(term) else np.zeros(0, bool)
        length = np.bincount(rows, minlength=n)
        mean = max(length.mean(), 1) if n else 1
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        self.doc = doc[shared]
        t, f = term[shared], tf[shared]
        del key, term, doc, tf, shared
        self.weight = idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * length[self.doc] / mean))
        self.ptr = np.searchsorted(t, np.arange(len(df) + 1))
        order = np.argsort(self.doc, kind="stable")
        self.query = t[order]
        self.q_ptr = np.searchsorted(self.doc[order], np.arange(n + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for all terms of the seed; 0 where none is shared."""
        terms = self.query[self.q_ptr[seed]: self.q_ptr[seed + 1]]
        if not len(terms):
            return np.zeros(self.n)
        first = self.ptr[terms]
        size = self.ptr[terms + 1] - first
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1])) + np.repeat(first - (ends - size), size)
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)

    def neighbours(self, seed: int, unused: np.ndarray, most: int | None = None) -> np.ndarray:
        """Unused documents that share a term with the seed, best first; if ``most`` is given, the best
        ``most`` and those that score like the last of them."""
        score = self.scores(seed)
        found = np.flatnonzero(unused & (score > 0))
        score = score[found]
        if most is not None and len(found) > most:
            best = score >= np.partition(score, len(score) - most)[len(score) - most]
            found, score = found[best], score[best]
        return found[np.argsort(-score, kind="stable")]


def fill(index: Bm25, sizes: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int, int, int]]:
    """(document, first id, ids, window, offset) of every piece; each size is 1 at least."""
    unused = np.ones(index.n, bool)
    out, at, used, row = [], 0, 0, 0
    d = asked = 0  # the document taken last; the seed
    queue: list[int] = []
    size = sizes.tolist()
    for _ in range(index.n):
        while queue and not unused[queue[-1]]:
            queue.pop()
        if used and not queue:  # the seed's next neighbours, else those of the document taken last
            queue = index.neighbours(asked, unused, AT_ONCE)[::-1].tolist()
            if not queue and asked != d:
                asked = d
                queue = index.neighbours(asked, unused, AT_ONCE)[::-1].tolist()
        if queue and used:
            d = queue.pop()
            seed = False
        else:
            while not unused[row]:
                row += 1
            d = row
            seed = True
        unused[d] = False
        start, left = 0, size[d]
        while left:
            take = min(left, window - used)
            out.append((d, start, take, at, used))
            start, left, used = start + take, left - take, used + take
            if used == window:
                at, used = at + 1, 0
                seed = left > 0
        if seed and used:  # a window has this document as its (next) seed
            asked, queue = d, []
    return out


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = END_ID,
         shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The pieces of all rows of ``docs`` (doc_id, text)."""
    tokenizer = tokenizer or default_tokenizer()

    def shard(doc_ids: list, texts: list, base: int):
        enc = encoder(tokenizer)
        ids, per, row, term, n = [], [], [], [], 0
        for buf, off in texts:
            for a, b in chunks(off):
                part, at = buf[off[a]: off[b]], off[a: b + 1] - off[a]
                flat, ends = enc.ids(part, at)
                count = np.diff(ends) + 1
                ended = np.full(len(flat) + b - a, end_id, "<u4")
                stay = np.ones(len(ended), bool)
                stay[np.cumsum(count) - 1] = False
                ended[stay] = flat
                ids.append(ended)
                per.append(count)
                r, _, _, h = words(part, at)
                row.append((r + n).astype(np.int32))
                term.append(h)
                n += b - a
        ids, per = np.concatenate(ids), np.concatenate(per)
        first = np.cumsum(per) - per
        index = Bm25(np.concatenate(row), np.concatenate(term), n)
        del row, term
        pieces = fill(index, per, window)
        d, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
        begin = first[d] + start
        crc = [zlib.crc32(ids[a: a + m]) for a, m in zip(begin.tolist(), length.tolist())]
        docs_ = pa.concat_arrays(doc_ids).take(pa.array(d))
        return pa.RecordBatch.from_arrays(
            [docs_, *(pa.array(x, pa.int64()) for x in (start, length, crc, per[d], seq + base, offset))],
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]), int(seq[-1]) + 1

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        doc_ids, texts, size = [], [], 0
        for batch in batches:
            column = batch.column("text")
            buf, off = utf8(column)
            a = 0
            while a < batch.num_rows:
                room = max(shard_bytes - size, 1)
                b = max(a + 1, int(np.searchsorted(off, off[a] + room, "right")) - 1)
                doc_ids.append(batch.column("doc_id").slice(a, b - a))
                texts.append((buf[off[a]: off[b]], off[a: b + 1] - off[a]))
                size += int(off[b] - off[a]) + b - a
                a = b
                if size >= shard_bytes:
                    out, n = shard(doc_ids, texts, base)
                    yield out
                    give_back()
                    base, doc_ids, texts, size = base + n, [], [], 0
        if doc_ids:
            yield shard(doc_ids, texts, base)[0]
        give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, PIECE)
