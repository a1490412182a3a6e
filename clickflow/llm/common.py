"""Shared helpers: scratch tables in the cluster's shared folder, whole-text
buffers and word hashes as numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Python regular expression of the words that all word-based operators use.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled by one numpy pass (a longer text is a pass of its own).
CHUNK_BYTES = 1 << 20

#: Spark's setting to drop the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Settings of a write; rows go to Python in batches of a few passes, as a batch is held in several copies beside the
#: executor's heap.
WRITE_SETTINGS = {SHUFFLE_CLEANUP: "true", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * CHUNK_BYTES)}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary folder only on a local master."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="clickflow-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """``values`` as the session's settings; those it had come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its rows are computed
    once, and a lost executor costs no more than the tasks that it was running. The write's
    shuffle files go when it ends, not when the driver happens to collect garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with settings(spark, WRITE_SETTINGS):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], label: str, name: str = "at") -> DataFrame:
    """``df`` written in ``order`` with each row's place 0, 1, ... over the whole table.

    Rows are dealt by ranges of ``order``, so a hot key is spread as far as the rest of the
    order tells its rows apart; the places before a partition are one number a partition,
    which is what is broadcast."""
    ties = F.monotonically_increasing_id()  # equal rows are dealt by their place in the input
    df = df.withColumn("__tie", ties).repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie")
    df = written(df.withColumns({"__part": F.spark_partition_id(), "__id": F.monotonically_increasing_id()})
                 .drop("__tie"), label)
    sizes = df.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__part", (before - F.col("__first")).alias("__shift"))
    return (df.join(F.broadcast(sizes), "__part").withColumn(name, F.col("__id") + F.col("__shift"))
            .drop("__part", "__id", "__shift"))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return (raw[off[0]: off[-1]], off - off[0]) if len(off) else (raw, np.zeros(1, np.int64))


def chunks(off: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [a, b) of about ``size`` bytes."""
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + size, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def give_back() -> None:
    """Hand the memory that numpy and Arrow have freed back to the system at a task's end: Spark keeps the
    worker for the tasks of later stages, beside the heap of the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32
_K = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_pow = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        p = np.full(max(n, 256), _BASE, np.uint64)
        p[0] = 1
        _pow = np.cumprod(p, dtype=np.uint64)
        if n > 1 << 20:  # a giant word's table isn't kept
            out, _pow = _pow, np.ones(1, np.uint64)
            return out
    return _pow


_inverse = np.ones(1, np.uint64)


def _inverses(n: int) -> np.ndarray:
    """The inverse of each power, modulo 2 to the 64th; n is at most 1 << 20."""
    global _inverse
    if len(_inverse) < n:
        p = np.full(n, pow(int(_BASE), -1, 1 << 64), np.uint64)
        p[0] = 1
        _inverse = np.cumprod(p, dtype=np.uint64)
    return _inverse


def span_hashes(buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the non-empty byte spans [first, first + size) of ``buf``."""
    if not len(first):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(size)
    at, total = ends - size, int(ends[-1])
    if total == len(buf) <= 1 << 20:  # they follow one another: one sum over all, powers count from a span's first byte
        sums = np.zeros(total + 1, np.uint64)
        scaled = buf + np.uint64(1)
        scaled *= _powers(total)[:total]
        np.cumsum(scaled, out=sums[1:])
        return mix((sums[ends] - sums[at]) * _inverses(total)[at] ^ (size.astype(np.uint64) * _K))
    short = np.int32 if total < 1 << 31 else np.int64
    inside = np.arange(total, dtype=short) - np.repeat(at.astype(short), size)
    if total != len(buf):
        buf = buf[inside + np.repeat(first.astype(short if len(buf) < 1 << 31 else np.int64), size)]
    scaled = _powers(int(size.max()))[inside]
    scaled *= buf + np.uint64(1)
    sums = np.add.reduceat(scaled, at)
    return mix(sums ^ (size.astype(np.uint64) * _K))


def words(buf: np.ndarray, off: np.ndarray, lower: bool = True):
    """(row, first byte, length, hash) of every word of the rows in ``buf``."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    solid = ~SPACE[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[off] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | cut[1:-1]
    first = np.flatnonzero(begins)
    size = np.flatnonzero(ends) + 1 - first
    row = np.searchsorted(off, first, "right") - 1
    return row, first, size, span_hashes(LOWER[buf] if lower else buf, first, size)


def shingles(row: np.ndarray, h: np.ndarray, n_rows: int, width: int):
    """(row, hash) of the ``width``-word shingles, repeats included; a row with fewer words
    gives its whole sequence as one shingle, a row without words none."""
    count = np.bincount(row, minlength=n_rows)
    start = np.concatenate(([0], np.cumsum(count)))
    acc = np.zeros(len(h), np.uint64)
    n = len(h) - width + 1
    if n > 0:
        part = np.zeros(n, np.uint64)
        for i in range(width):
            part = mix(part * _BASE + h[i: i + n] + _K)
        acc[:n] = part
    position = np.arange(len(h)) - start[row]
    whole = position + width <= count[row]
    rows, out = [row[whole]], [acc[whole]]
    few = np.flatnonzero((count > 0) & (count < width))
    if len(few):
        part, seen = np.zeros(len(few), np.uint64), count[few]
        for i in range(width - 1):
            more = seen > i
            part[more] = mix(part[more] * _BASE + h[start[few[more]] + i] + _K)
        rows.append(few)
        out.append(mix(part ^ seen.astype(np.uint64)))
    r, s = np.concatenate(rows), np.concatenate(out)
    if len(few):
        order = np.argsort(r, kind="stable")
        r, s = r[order], s[order]
    return r, s


def lists(values: np.ndarray, off: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))
