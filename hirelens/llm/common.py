"""Helpers shared by the training-data operators.

* scratch tables in the cluster's shared folder (written, read back, dropped);
* byte-level word handling for Arrow batches: words are maximal runs of bytes
  other than space and 0x09-0x0D, which is the same as ``[^\\x20\\x09-\\x0D]+``
  on the decoded text because UTF-8 never uses those bytes inside a character;
* 64-bit hashes of byte ranges for whole batches at once;
* connected components by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import unique_dir

WORD = r"[^\x20\x09-\x0D]+"

#: bytes of text that one vectorized step looks at; a longer text is one step
#: (what is made of them takes some hundred times as much)
STEP_BYTES = 1 << 18

_IS_WORD_BYTE = np.ones(256, bool)
_IS_WORD_BYTE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False


# ---------------------------------------------------------------- scratch

def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage (a lost executor re-reads files) and gives joins a plain
    scan on this side, so that AQE can see its size and split hot keys. The
    folder is remembered on the frame for :func:`drop`.
    """
    spark = df.sparkSession
    path = unique_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._scratch_path = path
    return back


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written inside gets its Arrow batches in ``rows`` rows at most,
    so that whole texts wait in neither the JVM nor its workers."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def drop(*frames: DataFrame) -> None:
    """Delete the folders of frames made by :func:`written` that nothing will
    read again."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = df.sparkSession._jvm
            conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked for joins that shuffle. The side is a table that grows with
    the input: Spark would judge it by the size of its files and build it on the
    driver, where packed numbers take many times that."""
    return df.hint("merge")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: extra columns, whatever their names, stay out."""
    return df.select(*[df[n] for n in names])


# ------------------------------------------------------------ text batches

def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    kind = np.int64 if wide else np.int32
    size = np.dtype(kind).itemsize
    if len(column) == 0 or where is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(where, kind, len(column) + 1, column.offset * size).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; every row is in exactly one."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray):
    """(start, end, row) of every word; words do not cross rows."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = _IS_WORD_BYTE[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before[edge] = False
    after[edge - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd


def process_cache() -> dict:
    """What this Python process keeps between tasks. Functions travel to the
    workers by value, so their module globals would start anew in each task
    (and would travel with them)."""
    import sys
    import types
    return sys.modules.setdefault("_hirelens_process", types.ModuleType("_hirelens_process")).__dict__


def start_task(kind: str) -> None:
    """Workers outlive their tasks. When one goes over to another kind of work,
    what it kept for the one before is given back to the system."""
    import ctypes
    import gc
    cache = process_cache()
    if cache.get("kind") not in (None, kind):
        for key in [k for k in cache if not (isinstance(k, str) and k.startswith("__"))]:
            del cache[key]
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library than glibc
            pass
    cache["kind"] = kind


def powers(lane: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    cache = process_cache()
    have = cache.get(("powers", lane, inverse))
    if have is None or len(have) < n:
        base = _BASES[lane]
        if inverse:
            base = pow(base, -1, 1 << 64)
        size = max(n, STEP_BYTES + 2)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 4 * STEP_BYTES:
            cache[("powers", lane, inverse)] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of data[start:end] for every range: polynomial prefix
    sums modulo 2**64, shifted to the range's start, mixed with its length."""
    n = len(data)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.multiply(data.astype(np.uint64) + np.uint64(1), powers(lane, n), out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    own = (total[end] - total[start]) * powers(lane, n + 1, inverse=True)[start]
    return mix(own + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hashes(values: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of every run values[i:i+length]."""
    n = len(values)
    if n < length:
        return np.zeros(0, np.uint64)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.multiply(values, powers(lane, n), out=total[1:])
    np.cumsum(total[1:], out=total[1:])
    own = (total[length:] - total[:-length]) * powers(lane, n + 1, inverse=True)[: n + 1 - length]
    return mix(own)


# ------------------------------------------------------------- components

def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): component
    is the smallest node reachable. Self-loops and repeats are allowed; nulls
    are dropped.

    Alternates large and small stars until the edge set stands still. The
    per-node minimum is written before it is joined back, so both sides of the
    join are plain exchanges and AQE splits a hot centre.
    """
    spark = edges.sparkSession
    now = written(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        name)

    def mark(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()

    seen = mark(now)
    while seen[0]:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("w"))
                      .select("u", F.least("u", "w").alias("m")), name)
        large = written(both.join(shuffled(low), "u").where("v > u")
                        .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), name)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = written(
            large.join(shuffled(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), name)
        drop(now, low, large, least)
        now, last = small, seen
        seen = mark(now)
        if tuple(seen) == tuple(last):
            break
    ends = now.groupBy("u").agg(F.min("v").alias("component"))
    roots = now.select(F.col("v").alias("u")).distinct().join(shuffled(ends.select("u")), "u", "left_anti")
    return (ends.select(F.col("u").alias("node"), "component")
            .unionByName(roots.select(F.col("u").alias("node"), F.col("u").alias("component"))))
