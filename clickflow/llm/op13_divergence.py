"""Source divergence audit with a minimal acyclic transducer as vocabulary.

First pass over the texts: document frequencies by language and term; the terms of a
language that ``min_docs`` of its documents hold are kept. The kept terms are dealt by
ranges, sorted, and built into minimal acyclic automata term by term (only the path of the
last term is open; closed states that are equal are one). Each arc carries the number of
terms that sort before those behind it, so a term's outputs sum to its ordinal in
lexicographic order: a transducer from terms to ordinals, and back. A shard ends after
``shard_terms`` terms or ``SHARD_BYTES`` bytes; shards that follow one another go on
counting.

Second pass: the terms of the texts, with their counts by source combined in each batch,
stream through the shard that may hold them; what comes out are ordinals, and counts by
language, source and ordinal are summed from there without a string. Shards never pass the
driver: only their first terms and sizes do, at most ``MOST_SHARDS`` of them, and
a shard's row travels to the tasks that stream its range, ``SALTS`` to a shard.

From the counts, with p = 1 + (10^9 * (count + 1)) // (N + V) and f = (p - q)^2 // q:
for each source and every other source of its language the sum of f over all kept terms
(``pair``), in slices of ``SLICE`` ordinals by blocks of ``BLOCK`` sources, so that no task
holds more than two blocks over one slice; and for each source its ``top`` terms that it
uses more than its language does (``term``), ties by ordinal. All arithmetic is on integers.

Defined results: null text, lang and source are empty strings; texts without terms count
as documents only; repeated rows are documents of their own; a language without kept terms
gives its pairs the value 0; ties in ``pair`` go by the other source; an empty table gives
no rows; extra columns are ignored. Long texts are whole; a term's length costs the builder
some 300 bytes of memory a byte while it is open.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import LOWER, chunks, numbered, utf8, written

MIN_DOCS, SCALE, TOP = 3, 1_000_000_000, 200
SHARD_TERMS, SHARD_BYTES, MOST_SHARDS, SALTS = 32768, 1 << 22, 1 << 16, 8
SLICE, BLOCK = 16384, 64

#: Bytes of terms: ASCII letters, and all of a character beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """(row, term) of every term of the rows in ``buf``; A to Z become lower case."""
    mine = LETTER[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    begins, ends = mine.copy(), mine.copy()
    begins[1:] &= ~mine[:-1] | cut[1:-1]
    ends[:-1] &= ~mine[1:] | cut[1:-1]
    first = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - first
    row = np.searchsorted(off, first, "right") - 1
    at = np.concatenate(([0], np.cumsum(size)))
    data = LOWER[buf[mine]]
    return row, pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(size), [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])


def _coded(column) -> tuple[np.ndarray, pa.Array]:
    """(codes, distinct values) of a column."""
    coded = column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def document_frequencies(docs: DataFrame) -> DataFrame:
    """lang, term, docs: in how many rows of ``docs`` (lang, text) each term occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, names = _coded(batch.column("lang"))
            buf, off = utf8(batch.column("text"))
            for a, b in chunks(off, 8 << 20):
                row, term = terms(buf[off[a]: off[b]], off[a: b + 1] - off[a])
                code, words = _coded(term)
                if not len(code):
                    continue
                pairs = np.unique(row * len(words) + code)
                key, n = np.unique(lang[a + pairs // len(words)] * len(words) + pairs % len(words), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))).cast(pa.binary()),
                     pa.array(n, pa.int64())], ["lang", "term", "docs"])

    found = docs.select("lang", "text").mapInArrow(run, "lang STRING, term BINARY, docs BIGINT")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


class Transducer:
    """A minimal acyclic automaton of sorted terms; arc outputs sum to a term's ordinal."""

    def __init__(self, keys: np.ndarray, target: np.ndarray, output: np.ndarray, final: np.ndarray, root: int):
        self.keys, self.target, self.output, self.final, self.root = keys, target, output, final, root

    @classmethod
    def build(cls, words) -> "Transducer":
        """``words``: distinct byte strings in ascending order, read once."""
        ids: dict = {}
        counts: list[int] = []
        open_arcs: list[list] = [[]]  # per state of the open path: its closed arcs (byte, state)
        open_final = [False]
        last = b""

        def close(depth: int) -> int:
            """Close the open state at the end of the path, which has ``depth`` + 1 states."""
            key = (open_final.pop(), tuple(open_arcs.pop()))
            state = ids.get(key)
            if state is None:
                state = ids[key] = len(counts)
                counts.append(key[0] + sum(counts[s] for _, s in key[1]))
            return state

        for word in words:
            n = same = min(len(word), len(last))
            if word[:n] != last[:n]:
                same = next(i for i in range(n) if word[i] != last[i])
            for depth in range(len(last), same, -1):
                state = close(depth)
                open_arcs[-1].append((last[depth - 1], state))
            for _ in range(same, len(word)):
                open_arcs.append([])
                open_final.append(False)
            open_final[-1] = True
            last = word
        for depth in range(len(last), 0, -1):
            state = close(depth)
            open_arcs[-1].append((last[depth - 1], state))
        root = close(0)
        keys, target, output, final = [], [], [], np.zeros(len(ids), bool)
        for (is_final, arcs), s in ids.items():
            final[s], before = is_final, int(is_final)
            for byte, t in arcs:
                keys.append(s * 256 + byte)
                target.append(t)
                output.append(before)
                before += counts[t]
        return cls(np.array(keys, np.int64), np.array(target, np.int32), np.array(output, np.int64), final, root)

    def fields(self) -> list[bytes]:
        return [self.keys.tobytes(), self.target.tobytes(), self.output.tobytes(), self.final.tobytes()]

    @classmethod
    def read(cls, keys: bytes, target: bytes, output: bytes, final: bytes, root: int) -> "Transducer":
        return cls(np.frombuffer(keys, np.int64), np.frombuffer(target, np.int32), np.frombuffer(output, np.int64),
                   np.frombuffer(final, bool), root)

    def ordinals(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """The ordinals of all terms ``data[off[i]: off[i + 1]]``, -1 for those that aren't in; all
        terms step through the arcs together, byte by byte."""
        size = np.diff(off)
        out = np.full(len(size), -1, np.int64)
        live = np.flatnonzero(size > 0)
        state = np.full(len(live), self.root, np.int64)
        total = np.zeros(len(live), np.int64)
        if not len(self.keys):
            return out
        k = 0
        while len(live):
            want = state * 256 + data[off[live] + k]
            arc = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[arc] == want
            live, arc, total = live[hit], arc[hit], total[hit]
            state, total, k = self.target[arc].astype(np.int64), total + self.output[arc], k + 1
            done = size[live] == k
            ends = done & self.final[state]
            out[live[ends]] = total[ends]
            live, state, total = live[~done], state[~done], total[~done]
        return out

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: at each state the last arc whose output isn't beyond it."""
        out, state = bytearray(), self.root
        while True:
            a, b = np.searchsorted(self.keys, [state * 256, state * 256 + 256])
            if ordinal == 0 and self.final[state]:
                return bytes(out)
            i = a + int(np.searchsorted(self.output[a:b], ordinal, "right")) - 1
            ordinal -= int(self.output[i])
            out.append(int(self.keys[i]) & 255)
            state = int(self.target[i])


_SHARD = "lang STRING, low BINARY, n BIGINT, keys BINARY, target BINARY, output BINARY, final BINARY, root INT"
_SHARD_ARROW = pa.schema([("lang", pa.string()), ("low", pa.binary()), ("n", pa.int64()), ("keys", pa.binary()), ("target", pa.binary()),
                          ("output", pa.binary()), ("final", pa.binary()), ("root", pa.int32())])


def build_shards(kept: DataFrame, shard_terms: int) -> DataFrame:
    """The transducers of ``kept`` (lang, term): lang, low (its first term), n and the automaton."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, words, size = None, [], 0

        def shard() -> pa.RecordBatch:
            t = Transducer.build(words)
            row = [lang, words[0], len(words), *t.fields(), t.root]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARD_ARROW)], schema=_SHARD_ARROW)

        for batch in batches:
            for name, word in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if words and (name != lang or len(words) >= shard_terms or size > SHARD_BYTES):
                    yield shard()
                    words, size = [], 0
                lang = name
                words.append(word)
                size += len(word)
        if words:
            yield shard()

    return kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(run, _SHARD)


#: A term's counts in one batch: (source, count) pairs, sources by a 64-bit hash.
COUNTS = np.dtype([("source", "<i8"), ("n", "<i8")])
#: Counts that a task sums up at a time.
HELD = 1 << 20


def source_key(source: Column) -> Column:
    return F.xxhash64(source)


class Vocabulary:
    """``shards``: lang, shard (a number over all languages), base (the ordinal of its first term) and
    the transducers; ``bounds``: per language the first terms, numbers and bases of its shards;
    ``sizes``: lang, v."""

    def __init__(self, kept: DataFrame, shard_terms: int | None = None):
        kept = written(kept, "audit-kept")
        if shard_terms is None:  # the number of shards, and so what the driver holds of them, is bounded
            shard_terms = max(SHARD_TERMS, kept.count() // MOST_SHARDS)
        shards = written(build_shards(kept, shard_terms), "audit-shards")
        self.bounds: dict[str, tuple[list, list, list]] = {}
        numbers = []
        for r in shards.select("lang", "low", "n").orderBy("lang", "low").toLocalIterator():
            lows, number, at = self.bounds.setdefault(r["lang"], ([], [], [0]))
            lows.append(bytes(r["low"]))
            number.append(len(numbers))
            numbers.append((r["lang"], bytearray(r["low"]), len(numbers), at[-1]))
            at.append(at[-1] + r["n"])
        spark = kept.sparkSession
        numbered_ = spark.createDataFrame(numbers, "lang STRING, low BINARY, shard INT, base BIGINT")
        self.shards = shards.drop("n").join(F.broadcast(numbered_), ["lang", "low"]).drop("low")
        self.sizes = shards.groupBy("lang").agg(F.sum("n").alias("v"))

    def _stream(self, rows: DataFrame, step, schema: str, arrow: pa.Schema) -> DataFrame:
        """``rows`` (shard, source, term, ...) with their shards: each task reads a shard's transducer,
        then the rows of its range in batches; ``step(shard's row, batch)`` gives columns."""
        salt = F.pmod(F.xxhash64("source", "term"), F.lit(SALTS))
        place = lambda salt, loads: (F.col("shard") * SALTS + salt).cast("bigint") * 2 + loads
        rows = rows.withColumn("place", place(salt, 1))
        each = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        shards = self.shards.withColumn("salt", each).withColumn("place", place(F.col("salt"), 0)).drop("salt")
        both = shards.drop("shard").unionByName(rows.drop("shard"), allowMissingColumns=True)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard = None
            for batch in batches:
                loads = np.flatnonzero(batch.column("place").to_numpy(zero_copy_only=False) % 2 == 0)
                for i, a in enumerate([-1, *loads]):
                    if a >= 0:
                        shard = {c: batch.column(c)[a].as_py() for c in ("lang", "keys", "target", "output", "final", "root", "base")}
                        shard["transducer"] = Transducer.read(*(shard.pop(c) for c in ("keys", "target", "output", "final", "root")))
                    b = loads[i] if i < len(loads) else batch.num_rows
                    if b > a + 1:
                        yield from (pa.RecordBatch.from_arrays(x, schema=arrow) for x in step(shard, batch.slice(a + 1, b - a - 1)))

        # one number to sort by: a shard's row, then the rows of its range
        return (both.repartition(F.shiftright("place", 1)).sortWithinPartitions("place").mapInArrow(run, schema))

    def recount(self, docs: DataFrame) -> DataFrame:
        """lang, source_key, ord, n: how often each kept term occurs in a source's texts of a language."""
        bounds = self.bounds

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lang, langs = _coded(batch.column("lang"))
                source, sources = _coded(batch.column("source"))
                hashes = sources.to_numpy(zero_copy_only=False)
                buf, off = utf8(batch.column("text"))
                for a, b in chunks(off, 8 << 20):
                    row, term = terms(buf[off[a]: off[b]], off[a: b + 1] - off[a])
                    code, words = _coded(term)
                    if not len(code):
                        continue
                    key, n = np.unique(((lang * len(words))[a + row] + code) * len(sources) + source[a + row], return_counts=True)
                    counts = np.empty(len(key), COUNTS)
                    counts["source"], counts["n"] = hashes[key % len(sources)], n
                    key //= len(sources)
                    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))  # a term of a language
                    ends = np.append(first, len(key)).astype(np.int64) * COUNTS.itemsize
                    held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [
                        None, pa.py_buffer(ends.tobytes()), pa.py_buffer(counts.tobytes())])
                    term_of = words.take(pa.array(key[first] % len(words)))
                    lang_of, shard = key[first] // len(words), np.full(len(first), -1, np.int32)
                    spelled = term_of.to_pylist()
                    for i, name in enumerate(langs.to_pylist()):
                        lows, number, _ = bounds.get(name, ([], [], []))
                        if lows:  # a term before the first one of its language isn't kept
                            shard[lang_of == i] = [number[x] if (x := bisect.bisect_right(lows, spelled[j]) - 1) >= 0 else -1
                                                   for j in np.flatnonzero(lang_of == i)]
                    at = pa.array(np.flatnonzero(shard >= 0))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard[shard >= 0]), pa.array(np.zeros(len(at), np.int64)), term_of.take(at).cast(pa.binary()),
                         held.take(at).cast(pa.binary())], ["shard", "source", "term", "counts"])

        def step(shard: dict, batch: pa.RecordBatch) -> Iterator[list]:
            found = shard["transducer"].ordinals(*_bytes(batch.column("term")))
            hit = np.flatnonzero(found >= 0)
            data, off = _bytes(batch.column("counts").take(pa.array(hit)))
            counts = data[off[0]: off[-1]].view(COUNTS)
            ords = np.repeat(found[hit], np.diff(off) // COUNTS.itemsize)
            for a in range(0, len(counts), HELD):
                source, at = np.unique(counts["source"][a: a + HELD], return_inverse=True)
                key, back = np.unique(ords[a: a + HELD] * len(source) + at, return_inverse=True)
                n = np.zeros(len(key), np.int64)
                np.add.at(n, back, counts["n"][a: a + HELD])
                yield [pa.array([shard["lang"]]).take(pa.array(np.zeros(len(key), np.int64))), pa.array(source[key % len(source)]),
                       pa.array(key // len(source) + shard["base"]), pa.array(n)]

        rows = docs.select("lang", source_key(F.col("source")).alias("source"), "text").mapInArrow(
            run, "shard INT, source BIGINT, term BINARY, counts BINARY")
        out = self._stream(rows, step, "lang STRING, source_key BIGINT, ord BIGINT, n BIGINT", pa.schema(
            [("lang", pa.string()), ("source_key", pa.int64()), ("ord", pa.int64()), ("n", pa.int64())]))
        return out.groupBy("lang", "source_key", "ord").agg(F.sum("n").alias("n"))

    def spelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` (lang, source, ord, value, rank) with the column item, the term of the ordinal."""
        bounds = self.bounds

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ords, shard = batch.column("ord").to_pylist(), []
                for name, o in zip(batch.column("lang").to_pylist(), ords):
                    _, number, at = bounds[name]
                    shard.append(number[bisect.bisect_right(at, o) - 1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), *(batch.column(c) for c in ("source", "ord", "value", "rank"))],
                    ["shard", "source", "ord", "value", "rank"])

        def step(shard: dict, batch: pa.RecordBatch) -> Iterator[list]:
            ords = batch.column("ord").to_pylist()
            items = [shard["transducer"].term(o - shard["base"]).decode() for o in ords]
            yield [pa.array([shard["lang"]] * len(ords), pa.string()), batch.column("source"), pa.array(items, pa.string()),
                   batch.column("value"), batch.column("rank")]

        routed = rows.select("lang", "source", "ord", "value", "rank").mapInArrow(
            run, "shard INT, source STRING, ord BIGINT, value BIGINT, rank INT").withColumn("term", F.lit(None).cast("binary"))
        return self._stream(routed, step, "lang STRING, source STRING, item STRING, value BIGINT, rank INT", pa.schema(
            [("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("rank", pa.int32())]))


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), off


def _share(n: str, total: str) -> Column:
    """1 + floor(10^9 * (n + 1) / (total + v)), exactly: a product of decimals, divided as integers."""
    return F.expr(f"1 + CAST((CAST({n} + 1 AS DECIMAL(20,0)) * {SCALE}) div CAST({total} + v AS DECIMAL(20,0)) AS BIGINT)")


def _pairs(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of f over one slice for the pairs of two blocks of sources (or within one)."""
    heads = rows[rows["ord"] < 0].sort_values(["block", "place"])
    width = int(heads["width"].iloc[0])
    at = {(int(b), int(p)): i for i, (b, p) in enumerate(zip(heads["block"], heads["place"]))}
    p = np.repeat(heads["p"].to_numpy(np.int64)[:, None], width, axis=1)
    cells = rows[rows["ord"] >= 0]
    line = np.array([at[k] for k in zip(cells["block"], cells["place"])], np.int64)
    p[line, cells["ord"].to_numpy(np.int64)] = cells["p"].to_numpy(np.int64)
    block, names = heads["block"].to_numpy(), heads["source"].to_numpy()
    lo, hi, out = int(key[2]), int(key[3]), []
    for i in range(len(names)):
        # every ordered pair once: across two blocks, or within the block that meets itself
        others = np.flatnonzero(block != block[i]) if lo != hi else np.delete(np.arange(len(names)), i)
        for a in range(0, len(others), 16):
            q = p[others[a: a + 16]]
            f = (p[i] - q) ** 2 // q
            out += [(key[0], names[i], names[j], int(x)) for j, x in zip(others[a: a + 16], f.sum(axis=1))]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def _pair_values(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value of every ordered pair of sources of a language."""
    blocks = groups.withColumn("block", F.expr(f"place div {BLOCK}"))
    # a block meets itself and every other block of its language
    meets = F.explode(F.transform(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(sources - 1) div {BLOCK}")), lambda o: F.struct(
        F.least(F.col("block"), o).alias("lo"), F.greatest(F.col("block"), o).alias("hi")))).alias("m")
    slices = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.expr(f"(v - 1) div {SLICE}"), F.lit(0))))
    heads = (blocks.withColumn("slice", slices).select(
        "lang", "slice", "block", "place", "source", "sources", F.lit(-1).cast("bigint").alias("ord"), F.col("p0").alias("p"),
        F.least(F.lit(SLICE), F.col("v") - F.col("slice") * SLICE).alias("width")))
    cells = (counts.join(blocks, ["lang", "source_key"]).withColumn("p", _share("n", "total")).select(
        "lang", F.expr(f"ord div {SLICE}").alias("slice"), "block", "place", F.lit(None).cast("string").alias("source"), "sources",
        F.expr(f"ord % {SLICE}").alias("ord"), "p", F.lit(0).cast("bigint").alias("width")))
    rows = heads.unionByName(cells).select("*", meets).select("*", "m.lo", "m.hi").drop("m", "sources")
    parts = rows.groupBy("lang", "slice", "lo", "hi").applyInPandas(_pairs, "lang STRING, source STRING, item STRING, value BIGINT")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, shard_terms: int | None = None) -> DataFrame:
    """lang, source, part, item, value, rank for all sources of ``docs`` (text, lang, source)."""
    docs = _texts(docs)
    vocabulary = Vocabulary(document_frequencies(docs).where(F.col("docs") >= min_docs), shard_terms)
    counts = written(vocabulary.recount(docs), "audit-counts")
    totals = counts.groupBy("lang", "source_key").agg(F.sum("n").alias("total"))
    groups = numbered(docs.select("lang", "source").distinct(), [F.col("lang"), F.col("source")], "audit-groups")
    groups = groups.withColumn("source_key", source_key(F.col("source")))
    if not groups.groupBy("lang", "source_key").count().where("count > 1").isEmpty():
        raise ValueError("two sources have the same 64-bit key")  # never counted as one
    langs = groups.groupBy("lang").agg(F.min("at").alias("first"), F.count("*").alias("sources"))
    groups = (groups.join(langs, "lang").join(vocabulary.sizes, "lang", "left").join(totals, ["lang", "source_key"], "left")
              .select("lang", "source", "source_key", (F.col("at") - F.col("first")).alias("place"), "sources",
                      F.coalesce("v", F.lit(0)).cast("bigint").alias("v"), F.coalesce("total", F.lit(0)).cast("bigint").alias("total")))
    groups = written(groups.withColumn("p0", F.when(F.col("v") > 0, _share("0L", "total")).otherwise(1)), "audit-sizes")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pair_values(counts, groups).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    whole = counts.groupBy("lang", "ord").agg(F.sum("n").alias("all_n"))
    sums = groups.groupBy("lang").agg(F.sum("total").alias("all_total"))
    used = (counts.join(groups.select("lang", "source", "source_key", "v", "total"), ["lang", "source_key"]).join(sums, "lang")
            .join(whole, ["lang", "ord"]).withColumn("p", _share("n", "total")).withColumn("q", _share("all_n", "all_total"))
            .where("p > q").select("lang", "source", "ord", F.expr("(p - q) * (p - q) div q").alias("value")))
    by_ordinal = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ord")
    best = written(used.withColumn("rank", F.row_number().over(by_ordinal)).where(F.col("rank") <= top), "audit-best")
    return pairs.unionByName(vocabulary.spelled(best).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
