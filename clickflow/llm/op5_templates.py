"""Line dedup by a log-template tree.

Every line with a word is parsed at fixed depth: by its number of tokens, then by
its ``LEAD`` leading tokens, to a leaf. Tokens with a digit are variable fields,
unless nine tenths of the line are (rows of numbers recur if they are the same).
Inside a leaf the line stands for several templates: the one of all its tokens,
and, from ``MIN_GENERAL`` tokens on, one for each third of the tokens behind the
leading ones with that third as a variable field. So lines that differ in numbers
or within one stretch of text meet in a template, and templates are keys: leaves
are counted, never gathered.

A template recurs if more than ``min_docs`` unrelated documents have it, however many copies
there are of any of them. A document has ``HASHES`` signatures for a line: the
smallest word-pair hashes of its other lines, by as many hash functions. Of the
documents with a template those count that are the first with ``NEW`` of their
signatures at least: a copy shares all with the first one, a near copy most (if a
share e of its word pairs is its own, all but about 28 e^6 of the near copies), as
do documents that consist of little else than the same lines. So the lines of a text
that was merely copied a
thousand times don't count as templates (near-dedup's business), while a notice in
different texts does, however long it is and however often one of them was copied.
Lines of recurring templates are dropped from every document; lines of fewer than
``min_tokens`` tokens are left alone.

Defined results: a null text stays null and has no lines; blank lines and empty
texts stay as they are; a document all of whose lines recur gets the empty text;
repeated rows are one document for the counts and treated alike; null doc_ids are
rows like others; of templates that a line stands for any one that recurs drops it; long
texts are parsed whole, one at a time; an empty table gives no rows; extra columns pass
through, but n_lines and n_dropped, if there are such columns, give way to the results
(names that begin with __template_ are reserved).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, give_back, mix, utf8, words, written

LEAD, MIN_GENERAL, MIN_TOKENS, MIN_DOCS, PARTS, HASHES, NEW = 2, 8, 3, 8, 3, 8, 6

_DIGIT = np.zeros(256, np.uint8)
_DIGIT[0x30:0x3A] = 1
_FIELD = np.uint64(0x5851F42D4C957F2D)
_FIELDS = mix(np.arange(1, PARTS + 1, dtype=np.uint64) ^ _FIELD)
_SEEDS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))
_NONE = np.uint64(np.iinfo(np.uint64).max)
SIGS = [f"s{i}" for i in range(HASHES)]


def outside(h: np.ndarray, start: np.ndarray, n: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """For each hash function the signature of each line (its words begin at ``start``): the smallest word-pair hash
    of the row's lines with another smallest one; a line of one word has the word's."""
    pair = mix(h * _SEEDS[0] + np.append(h[1:], h[:1]))
    last = start + n - 1
    pair[last] = h[last]
    alone = n == 1
    begin = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(row))))
    out = []
    for seed in _SEEDS:
        x = mix(pair ^ seed)
        x[last[~alone]] = _NONE
        line = np.minimum.reduceat(x, start)
        first = np.minimum.reduceat(line, begin)[of]
        second = np.minimum.reduceat(np.where(line == first, _NONE, line), begin)[of]
        out.append((np.where(line == first, second, first) >> np.uint64(32)).astype(np.uint32).view(np.int32))
    return out


def templates(buf: np.ndarray, off: np.ndarray, lead: int = LEAD, min_general: int = MIN_GENERAL,
              min_tokens: int = MIN_TOKENS):
    """(row, line number, template key, signatures) of every template of the lines that are long enough."""
    row, first, size, h = words(buf, off)
    if not len(h):
        z = np.zeros(0, np.int64)
        return z, z, z, [np.zeros(0, np.int32)] * HASHES
    digits = np.concatenate(([0], np.cumsum(_DIGIT[buf])))
    field = digits[first + size] > digits[first]
    breaks = np.flatnonzero(buf == 10)
    before = np.searchsorted(breaks, first)  # line ends before each word, over all rows
    line = before - np.searchsorted(breaks, off)[row]
    start = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])))
    n = np.diff(np.append(start, len(h)))
    pos = np.arange(len(h)) - np.repeat(start, n)
    sigs = outside(h, start, n, row[start])
    mostly = 10 * np.add.reduceat(field.astype(np.int64), start) > 9 * n
    h = np.where(field & ~np.repeat(mostly, n), _FIELD, h)
    # the path: token count and leading tokens; then the sum of the tokens with their places
    placed = mix(h + mix(pos.astype(np.uint64) + np.uint64(1)))
    total = np.add.reduceat(placed, start)
    leaf = mix(n.astype(np.uint64))
    for i in range(lead):
        at = np.minimum(start + i, start + n - 1)
        leaf = mix(leaf ^ np.where(i < n, placed[at], np.uint64(0)))
    of_n = np.repeat(n, n)
    part = np.where(pos < lead, PARTS, (pos - lead) * PARTS // np.maximum(of_n - lead, 1))
    long_enough = n >= min_tokens
    keys, at = [mix(leaf ^ total)[long_enough]], [np.flatnonzero(long_enough)]
    general = n >= min_general
    for j in range(PARTS):
        field = np.add.reduceat(np.where(part == j, placed, np.uint64(0)), start)
        keys.append(mix((leaf ^ (total - field)) + _FIELDS[j])[general])
        at.append(np.flatnonzero(general))
    at = np.concatenate(at)
    return row[start][at], line[start][at], np.concatenate(keys).view(np.int64), [x[at] for x in sigs]


def _row_id():
    """One identity for all rows with the same doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def line_templates(docs: DataFrame, **options) -> DataFrame:
    """rid, line, key, signatures: a row per line and template of ``docs`` (doc_id, text)."""
    def run(batches):
        for batch in batches:
            rid = np.asarray(batch.column("rid"))
            buf, off = utf8(batch.column("text"))
            for a, b in chunks(off):
                row, line, key, sigs = templates(buf[off[a]: off[b]], off[a: b + 1] - off[a], **options)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[a:b][row]), pa.array(line, pa.int32()), pa.array(key), *map(pa.array, sigs)],
                    ["rid", "line", "key", *SIGS])
        give_back()

    return docs.select(_row_id().alias("rid"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "rid BIGINT, line INT, key BIGINT, " + ", ".join(f"{x} INT" for x in SIGS))


def recurring(lines: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """key of every template that stands in enough unrelated documents of ``lines`` (rid, line, key, signatures).

    Counted in steps: a template's lines (combined before the shuffle) leave few candidates, copies are
    combined, and each signature of a template goes to the first document that has it."""
    often = lines.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > min_docs).select("key")
    docs = lines.join(often, "key").groupBy("key", *SIGS).agg(F.min("rid").alias("rid"))
    sig = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("sig")) for i, x in enumerate(SIGS)])).alias("s")
    first = docs.select("key", "rid", sig).groupBy("key", "s").agg(F.min("rid").alias("rid"))
    new = first.groupBy("key", "rid").agg(F.countDistinct("s.i").alias("n")).where(F.col("n") >= NEW)
    return new.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > min_docs).select("key")


def drop_templates(docs: DataFrame, min_docs: int = MIN_DOCS, **options) -> DataFrame:
    """All columns of ``docs`` (doc_id, text) with the recurring lines dropped from text (n_chars, if there
    is one, follows), and n_lines and n_dropped of every row."""
    lines = written(line_templates(docs, **options), "lines")
    keys = written(recurring(lines, min_docs), "templates")
    # a document's lines are gathered, never a template's
    drop = (lines.join(keys, "key").groupBy(F.col("rid").alias("__template_rid"))
            .agg(F.collect_set("line").alias("__template_drop")))
    kept = F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("__template_drop", i))
    text = F.when(F.col("__template_drop").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = (docs.withColumn("__template_rid", _row_id()).join(drop, "__template_rid", "left")
           .withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long"))
           .withColumn("n_dropped", F.coalesce(F.size("__template_drop"), F.lit(0)).cast("long"))
           .withColumn("text", text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.drop("__template_rid", "__template_drop")
