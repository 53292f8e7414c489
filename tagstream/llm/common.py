"""Shared helpers: table access, scratch tables, text batches, components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
HASH_BYTES = 1 << 18     # bytes hashed at once: some 50 bytes of working memory each


# Vectored reads keep a direct buffer of a whole column chunk in every reader thread,
# memory beside the heap that nothing bounds; text chunks are tens of MB.
READ = {"parquet.hadoop.vectored.io.enabled": "false"}


def bounded_reads(spark: SparkSession) -> None:
    """The same for tables that a caller opened in this session."""
    for k, v in READ.items():
        spark.conf.set(k, v)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.options(**READ).parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written below the folder named by ``spark.checkpoint.dir``.

    A written table cuts the lineage, survives lost executors and has a known
    size, so Spark itself checks that size before it broadcasts one. The
    session's setting is used; only a session without one gets a private folder
    (tests).
    """

    def __init__(self, spark: SparkSession, tag: str) -> None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            base = tempfile.mkdtemp(prefix="tagstream-llm-")
            spark.conf.set("spark.checkpoint.dir", base)
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.options(**READ).schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table of this scratch that no later plan reads."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path(name))
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


TRIM_BYTES = 1 << 20     # of Arrow batches after which a worker gives memory back
_passed = 0


def trimmed(run):
    """A mapInArrow function that gives freed memory back when its partition is done.

    Python workers are used again for later stages; without it each keeps the
    largest heap that any of its tasks needed. Small partitions count together:
    giving back takes longer than they do.
    """
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        global _passed

        def counted(some: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            global _passed
            for b in some:
                _passed += b.nbytes
                yield b

        yield from counted(run(counted(batches)))
        if _passed >= TRIM_BYTES:
            release()
            _passed = 0
    return wrapped


def release() -> None:
    """Gives freed memory of this process back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):      # glibc has it
        trim(0)


class TextBatch:
    """A string column of one Arrow batch as raw bytes and offsets; null is empty."""

    def __init__(self, column: pa.Array) -> None:
        column = column.fill_null("") if column.null_count else column
        kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
        _, offsets, data = column.buffers()
        n = len(column)
        self.offsets = np.frombuffer(offsets, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
        self.data = np.frombuffer(data, dtype=np.uint8) if data is not None and n else np.zeros(0, np.uint8)
        self.n = n

    def slices(self, target: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
        """Row ranges of about ``target`` bytes each (a longer text is a range of its own)."""
        lo = 0
        while lo < self.n:
            hi = int(np.searchsorted(self.offsets, self.offsets[lo] + target, side="right")) - 1
            hi = min(max(hi, lo + 1), self.n)
            yield lo, hi
            lo = hi

    def __getitem__(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_BASE = 0x5851F42D4C957F2D
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])      # [\\x20\\x09-\\x0D]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) <= n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _POWERS[k] = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, b, np.uint64)]), dtype=np.uint64)
    return _POWERS


def _word_hashes(x: np.ndarray) -> np.ndarray:
    edge = np.diff(np.concatenate([[True], SPACES[x], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    up, down = _powers(len(x))
    sums = np.zeros(len(x) + 1, np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:len(x)], dtype=np.uint64, out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each white-space separated word of the bytes ``x``, block by block."""
    parts, at = [], 0
    while at < len(x):
        end = min(at + HASH_BYTES, len(x))
        while end < len(x) and not SPACES[x[end]]:       # a block ends between words
            step = SPACES[x[end:end + 4096]]
            end += int(step.argmax()) if step.any() else len(step)
        parts.append(_word_hashes(x[at:end]))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def components(spark: SparkSession, scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: rows (node, component), component = smallest node.

    Alternates the large-star and small-star steps (Kiveris et al. 2014) on
    written tables until the edges are stars around the smallest nodes; each step
    is a partial aggregate and a join, so no component meets in one task. Nodes
    without an edge are absent; self loops and null ends are ignored.
    """
    def stars(df: DataFrame) -> bool:
        ends = df.select("u", "v").union(df.select("v", F.lit(None).cast(df.schema["v"].dataType)))
        return ends.groupBy("u").agg(F.count("*").alias("n"), F.count("v").alias("up")).where("up > 0 AND n > 1").isEmpty()

    cur = scratch.put(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "cc0")
    step = 0
    while not stars(cur):
        both = cur.union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low2, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                                F.struct("u", F.col("m").alias("v")))).alias("e"))
                 .select("e.*").where("u <> v").distinct())
        step += 1
        new = scratch.put(small, f"cc{step}")
        scratch.drop(f"cc{step - 1}")
        cur = new
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.union(roots)
