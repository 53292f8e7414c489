"""Exact deduplication screened by static binary-fuse filters.

A snapshot is an immutable set of texts: one row per distinct normalised text
(digest, the row that stays, group size), split in digest buckets of bounded
size, each with a static 8-bit binary-fuse filter. Digests of a new batch are
grouped among themselves first, then probe the filter of their bucket. Only
positives join the snapshot's rows of the same digest, and the normalised
bytes of the two representatives are compared before the groups are merged.

Defined cases: a null text counts as empty; texts that are only white space
are equal to empty ones; a null doc_id comes after every other; rows that
repeat a doc_id count as rows of their own in ``group_size``, and equal texts of
the id that stays are all ``kept`` in the decisions, while ``keep_unique`` keeps
one row of each text, whatever the ids; an empty table gives an empty result;
other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch, TextBatch, mix64

WHITE = b" \t\n\v\f\r"          # the characters [\x20\x09-\x0D]
BUCKET_KEYS = 32768             # distinct digests a filter bucket is sized for


# ------------------------------------------------------------------ digests
def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = TextBatch(b.column(1))
        sha, points = [], np.zeros(text.n, np.int64)
        for i in range(text.n):
            raw = text[i]
            sha.append(hashlib.sha256(raw.translate(None, WHITE)).digest())
            points[i] = len(raw.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(sha, pa.binary()), pa.array(points)], names=["doc_id", "sha", "points"])


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, sha (of the text without white space), points (code points of the text)."""
    return docs.select("doc_id", "text").mapInArrow(_digest_batches, "doc_id long, sha binary, points long")


def group_rows(rows: DataFrame) -> DataFrame:
    """One row per digest: the row that stays (most code points, then smallest id, null last) and the group's size."""
    return rows.groupBy("sha").agg(
        F.min(F.struct((-F.col("points")).alias("neg"), F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("best"),
        F.count("*").alias("size"))


# ------------------------------------------------------- binary-fuse filter
def _key64(sha: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(s[:8] for s in sha), dtype=">u8").astype(np.uint64)


def _layout(n: int) -> tuple[int, int]:
    """(segment length, segment count) of a 3-wise binary-fuse filter for n keys."""
    seg = 1 << max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    seg = min(seg, 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    return seg, max(1, int(np.ceil(n * factor / seg)) - 2)


def _slots(keys: np.ndarray, seed: int, seg: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    first = ((h >> np.uint64(32)) * np.uint64(count * seg)) >> np.uint64(32)
    mask = np.uint64(seg - 1)
    second = (first + np.uint64(seg)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * seg)) ^ (h & mask)
    print_ = (mix64(h) & np.uint64(0xFF)).astype(np.uint8)
    return np.stack([first, second, third], axis=1).astype(np.int64), print_


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segment count, fingerprints) for distinct 64-bit keys, peeled layer by layer."""
    keys = np.unique(keys)
    seg, count = _layout(len(keys))
    size = (count + 2) * seg
    for seed in range(1, 1000):
        slots, prints = _slots(keys, seed, seg, count)
        load = np.bincount(slots.ravel(), minlength=size)
        mixed = np.zeros(size, np.int64)          # xor of the keys' numbers in a slot
        np.bitwise_xor.at(mixed, slots.ravel(), np.repeat(np.arange(len(keys)), 3))
        layers, left = [], len(keys)
        while left:
            lone = np.flatnonzero(load == 1)
            if not len(lone):
                break
            who, at = np.unique(mixed[lone], return_index=True)
            lone = lone[at]
            layers.append((who, lone))
            np.subtract.at(load, slots[who].ravel(), 1)
            np.bitwise_xor.at(mixed, slots[who].ravel(), np.repeat(who, 3))
            left -= len(who)
        if left:
            continue
        table = np.zeros(size, np.uint8)
        for who, at in reversed(layers):
            own = table[slots[who]]
            table[at] = prints[who] ^ own[:, 0] ^ own[:, 1] ^ own[:, 2] ^ table[at]
        return seed, seg, count, table.tobytes()
    raise RuntimeError("no seed peels these keys")


def probe_filter(keys: np.ndarray, seed: int, seg: int, count: int, table: bytes) -> np.ndarray:
    """True where a key may be in the filter (always for its keys, once in 256 for others)."""
    slots, prints = _slots(keys, seed, seg, count)
    own = np.frombuffer(table, np.uint8)[slots]
    return (own[:, 0] ^ own[:, 1] ^ own[:, 2]) == prints


# ----------------------------------------------------------------- snapshot
def _bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64("sha"), F.lit(n)).cast("int").alias("bucket")


def bucket_count(n_groups: int) -> int:
    return max(1, -(-n_groups // BUCKET_KEYS))


def _build_group(pdf: pd.DataFrame) -> pd.DataFrame:
    seed, seg, count, table = build_filter(_key64(pdf["sha"]))
    return pd.DataFrame([{"bucket": pdf["bucket"].iloc[0], "seed": seed, "seg": seg, "segments": count,
                          "prints": table}])


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """One static filter row per digest bucket of a snapshot's groups."""
    return (groups.select(_bucket(buckets), "sha").groupBy("bucket")
            .applyInPandas(_build_group, "bucket int, seed long, seg long, segments long, prints binary"))


def _probe_group(new: pd.DataFrame, flt: pd.DataFrame) -> pd.DataFrame:
    if not len(new):
        return pd.DataFrame({"sha": [], "maybe": []})
    if not len(flt):
        return pd.DataFrame({"sha": new["sha"], "maybe": False})
    f = flt.iloc[0]
    hit = probe_filter(_key64(new["sha"]), int(f["seed"]), int(f["seg"]), int(f["segments"]), f["prints"])
    return pd.DataFrame({"sha": new["sha"], "maybe": hit})


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """(sha, maybe) of a new batch's groups; a bucket's digests meet its filter, texts and copies never do."""
    return (groups.select(_bucket(buckets), "sha").groupBy("bucket")
            .cogroup(filters.groupBy("bucket")).applyInPandas(_probe_group, "sha binary, maybe boolean"))


# -------------------------------------------------------------- byte checks
def _normal_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = TextBatch(b.column(0))
        bare = [text[i].translate(None, WHITE) for i in range(text.n)]
        yield pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(x).digest() for x in bare], pa.binary()),
                                          pa.array(bare, pa.binary())], names=["sha", "bare"])


def same_bytes(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Digests of ``pairs(sha, left_id, right_id)`` whose two texts, white space deleted, hold the same bytes."""
    ids = pairs.select(F.explode(F.array("left_id", "right_id")).alias("doc_id")).distinct().select(F.struct("doc_id").alias("id"))
    # the struct makes a null id equal to itself
    texts = docs.select(F.struct("doc_id").alias("id"), "text").join(ids, "id", "left_semi").select("text")
    bare = texts.mapInArrow(_normal_batches, "sha binary, bare binary")
    return (bare.join(pairs.select("sha"), "sha", "left_semi").groupBy("sha")
            .agg(F.min("bare").alias("lo"), F.max("bare").alias("hi")).where("lo = hi").select("sha"))


# ----------------------------------------------------------------- operator
def exact_dedup(spark: SparkSession, snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """Decide every row of ``snapshot`` and ``incoming`` (doc_id, text, ...) together.

    Returns one row per input row: doc_id, keep_id, group_size, kept,
    text_sha256. Of equal texts the one with the most code points stays, then
    the smallest doc_id.
    """
    scratch = Scratch(spark, "exact-dedup")
    docs = snapshot.select("doc_id", "text").union(incoming.select("doc_id", "text"))
    rows = scratch.put(digests(snapshot).withColumn("old", F.lit(True))
                       .union(digests(incoming).withColumn("old", F.lit(False))), "digests")
    old = scratch.put(group_rows(rows.where("old")), "old")
    new = scratch.put(group_rows(rows.where("not old")), "new")
    buckets = bucket_count(max(old.count(), new.count()))
    filters = scratch.put(build_filters(old, buckets), "filters")
    maybe = scratch.put(screen(new, filters, buckets).where("maybe").select("sha"), "maybe")
    # positives join the snapshot's exact rows; false positives find none
    o, n = old.alias("o"), new.join(maybe, "sha", "left_semi").alias("n")
    pairs = scratch.put(n.join(o, "sha").select("sha", F.col("o.best.doc_id").alias("left_id"),
                                                F.col("n.best.doc_id").alias("right_id")), "pairs")
    both = scratch.put(same_bytes(docs, pairs), "both")
    merged = (old.join(both, "sha", "left_semi").union(new.join(both, "sha", "left_semi"))
              .groupBy("sha").agg(F.min("best").alias("best"), F.sum("size").alias("size")))
    alone = (old.withColumn("old", F.lit(True)).union(new.withColumn("old", F.lit(False)))
             .join(both, "sha", "left_anti"))
    groups = (alone.select("sha", "best", "size", F.array("old").alias("sides"))
              .union(merged.select("sha", "best", "size", F.array(F.lit(True), F.lit(False)))))
    groups = groups.select("sha", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
                           F.explode("sides").alias("old"))
    return (rows.join(groups, ["sha", "old"])
            .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def keep_unique(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, with all its columns (half the ids form the snapshot).

    An id that stands in one row decides for its row. Rows whose id is null or
    repeated are written with a row number and decided one by one.
    """
    scratch = Scratch(spark, "exact-keep")
    decided = scratch.put(exact_dedup(spark, *split_batches(docs)).select("doc_id", "keep_id", "kept", "text_sha256"), "decided")
    odd = scratch.put(decided.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
                      .select(F.struct("doc_id").alias("_id")), "odd")
    drop = scratch.put(decided.where("NOT kept AND doc_id IS NOT NULL").select(F.struct("doc_id").alias("_id")).distinct()
                       .union(odd).distinct(), "drop")
    named = docs.withColumn("_id", F.struct("doc_id"))
    plain = named.join(drop, "_id", "left_anti").select(docs.columns)
    if odd.isEmpty():
        return plain
    rows = scratch.put(named.join(odd, "_id", "left_semi").drop("_id").withColumn("_row", F.monotonically_increasing_id()), "rows")
    # of the rows that carry a text's staying id, the longest, then the first, stays
    own = (rows.select(F.col("_row").alias("doc_id"), "text").mapInArrow(_digest_batches, "doc_id long, sha binary, points long")
           .select(F.col("doc_id").alias("_row"), F.lower(F.hex("sha")).alias("text_sha256"), "points"))
    keepers = decided.select("text_sha256", F.struct(F.col("keep_id").alias("doc_id")).alias("_id")).distinct()
    ids = rows.select("_row", F.struct("doc_id").alias("_id"))
    best = (own.join(ids, "_row").join(keepers, ["text_sha256", "_id"], "left_semi").groupBy("text_sha256")
            .agg(F.min(F.struct((-F.col("points")).alias("neg"), "_row")).alias("best")).select(F.col("best._row").alias("_row")))
    return plain.unionByName(rows.join(best, "_row", "left_semi").select(docs.columns))


def split_batches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One table as a snapshot and the batch that arrives after it, by a hash of the id."""
    first = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    return docs.where(first), docs.where(~first)
