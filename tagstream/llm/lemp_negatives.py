"""Hard-negative mining by LEMP-style coordinate pruning.

All rows are ordered by length and cut into groups and blocks of nearby lengths
(the length buckets). A block keeps its vectors and, for every coordinate, the
order of its unit vectors by that coordinate (the sorted lists). An anchor asks
a block only for scores of at least a threshold. The block's longest vector
turns that into a smallest cosine t, and the block is skipped when t > 1. For
the anchor's largest (focus) coordinates the angle between a row and the
coordinate's axis can differ from the anchor's by at most arccos(t): that is a
range of the sorted list. The shortest range is read, the others intersect it,
and what is left is verified by exact inner products.

Thresholds: for positives the running k-th best score of the anchor; for
negatives the lower end of the score window, or the running k-th best within
it. Both searches are exact. Anchors and blocks meet per (group, anchor
chunk), both of bounded size; each task returns at most k rows per search, and a
window merges them.

Scores are integer: each component x becomes floor(scale * x), x as double.
Products run in float64, which is exact as squared lengths stay below 2^53.

Defined cases: a row with a null id, label or vector, a null or non-finite
component, or a squared scaled length of 2^53 or more takes no part; vectors
of different lengths are compared as if padded with zeros, an empty vector is
all zeros; rows that share an id are rows of their own, and ties by id then go by
their position in the written table; a negative positive score has an empty
score window; an anchor without another row of its label returns nothing;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch

BLOCK_ROWS = 1024                    # rows of a length bucket
GROUP_ROWS = (1024, 65_536)          # fewest and most rows that meet a chunk of anchors in one task
SPREAD = 64                          # groups wished for between these
ANCHOR_CHUNK = 2048                  # expected anchors that meet a group in one task
FOCUS = 4                            # focus coordinates of an anchor
SLACK = 1e-9                         # rounding of cosines and angles
EXACT = float(1 << 53)


# ------------------------------------------------------------------------ index
def _scaled(vectors: DataFrame, anchor: Column, scale: int) -> DataFrame:
    """Rows that take part: row, vec_id, label, q (scaled components), len2, anchor."""
    x = F.col("embedding")
    fine = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    doubles = vectors.where(x.isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).where(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda v: v.cast("double") * F.lit(float(scale))).alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    doubles = doubles.where(F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v) < 2 * EXACT)
    whole = doubles.withColumn("q", F.transform("q", lambda v: F.floor(v)))
    return (whole.withColumn("len2", F.aggregate("q", F.lit(0).cast("long"), lambda s, v: s + v * v))
            .where(F.col("len2") < int(EXACT)).withColumn("row", F.monotonically_increasing_id()))


def _matrix(q: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as a matrix, padded with zeros."""
    sizes = q.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(q), dim), np.int32)
    values = q.flatten().to_numpy(zero_copy_only=False)
    if len(values) == out.size:
        return values.reshape(out.shape).astype(np.int32)
    out[np.arange(dim)[None, :] < sizes[:, None]] = values
    return out


BLOCKS = "g int, block long, n int, max_len2 long, rows binary, ids binary, labels binary, q binary, lists binary"


def _build(dim: int):
    """Blocks of a partition whose rows come by falling length."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, size = 0, 0, [], 0

        def block(t: pa.Table) -> pa.RecordBatch:
            nonlocal made
            q = _matrix(t["q"].combine_chunks(), dim)
            unit = _unit(q.astype(np.float64))
            lists = np.argsort(unit.T, axis=1, kind="stable").astype(np.uint16)
            made += 1
            one = [t["row"].to_numpy(), t["vec_id"].to_numpy(), t["label"].to_numpy(), q, lists]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([(part << 32) + made], pa.int64()), pa.array([len(q)], pa.int32()),
                 pa.array([t["len2"].to_numpy().max()], pa.int64()), *[pa.array([a.tobytes()], pa.binary()) for a in one]],
                names=[c.split()[0] for c in BLOCKS.split(", ")])

        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("g")[0].as_py()
            held.append(b)
            size += b.num_rows
            while size >= BLOCK_ROWS:
                t = pa.Table.from_batches(held)
                yield block(t.slice(0, BLOCK_ROWS))
                held, size = t.slice(BLOCK_ROWS).to_batches(), size - BLOCK_ROWS
        if size:
            yield block(pa.Table.from_batches(held))
    return build


def _unit(q: np.ndarray) -> np.ndarray:
    length = np.sqrt((q * q).sum(axis=1, keepdims=True))
    return q / np.where(length > 0, length, 1.0)


class _Block:
    def __init__(self, b, dim: int) -> None:
        n = int(b.n)
        self.rows, self.ids, self.labels = (np.frombuffer(x, np.int64) for x in (b.rows, b.ids, b.labels))
        self.q = np.frombuffer(b.q, np.int32).reshape(n, dim).astype(np.float64)
        self.unit = _unit(self.q)
        self.lists = np.frombuffer(b.lists, np.uint16).reshape(dim, n)
        self.longest = math.sqrt(b.max_len2)
        self.sorted: dict[int, np.ndarray] = {}

    def candidates(self, unit: np.ndarray, focus: np.ndarray, t: float) -> np.ndarray | slice:
        """Rows whose cosine with the anchor can reach ``t``."""
        if t <= 0:
            return slice(None)
        turn, best, ranges = math.acos(min(1.0, t)) + SLACK, None, []
        for f in focus:
            if f not in self.sorted:
                self.sorted[f] = self.unit[self.lists[f], f]
            at = math.acos(max(-1.0, min(1.0, unit[f])))
            lo, hi = math.cos(min(math.pi, at + turn)) - SLACK, math.cos(max(0.0, at - turn)) + SLACK
            i, j = np.searchsorted(self.sorted[f], (lo, hi + SLACK))
            ranges.append((f, lo, hi))
            if best is None or j - i < best[0]:
                best = j - i, f, i, j
        _, f, i, j = best
        found = self.lists[f][i:j]
        for g, lo, hi in ranges:
            if g != f and len(found):
                x = self.unit[found, g]
                found = found[(x >= lo) & (x <= hi)]
        return found


# ----------------------------------------------------------------------- search
FOUND = "anchor_row long, window long, row long, vec_id long, score long"


class _Best:
    """The first k of one search by falling score, then id, then row."""

    def __init__(self, k: int, low: float, high: float) -> None:
        self.k, self.low, self.high = k, low, high
        self.score = self.id = self.row = np.zeros(0, np.int64)

    @property
    def threshold(self) -> float:
        return max(self.low, self.score[-1]) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        keep = (score >= self.threshold) & (score <= self.high)
        if keep.any():
            s, i, r = (np.concatenate(x) for x in ((self.score, score[keep]), (self.id, ids[keep]), (self.row, rows[keep])))
            o = np.lexsort((r, i, -s))[:self.k]
            self.score, self.id, self.row = s[o], i[o], r[o]


def _search(dim: int, k: int, same: bool):
    """Per (group, anchor chunk): every anchor's first k rows of each of its score windows."""
    def run(blocks: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(blocks) and len(anchors):
            asked = []
            for a in anchors.itertuples(index=False):
                q = np.zeros(dim)
                q[:len(a.q)] = a.q
                length = math.sqrt(float(q @ q))
                unit = q / length if length else q
                best = [_Best(k, lo, hi) for lo, hi in zip(a.low, a.high)]
                asked.append((a, q, length, unit, np.argsort(-np.abs(unit), kind="stable")[:FOCUS], best))
            for b in blocks.sort_values(["max_len2", "block"], ascending=[False, True]).itertuples(index=False):
                block = _Block(b, dim)
                for a, q, length, unit, focus, best in asked:
                    theta, reach = min(w.threshold for w in best), length * block.longest
                    if theta > reach * (1 + SLACK):
                        continue
                    at = block.candidates(unit, focus, theta / reach - SLACK if reach and theta > 0 else 0.0)
                    label = block.labels[at] == a.label
                    keep = label & (block.rows[at] != a.row) if same else ~label
                    score = np.rint(block.q[at] @ q).astype(np.int64)[keep]
                    ids, rows = block.ids[at][keep], block.rows[at][keep]
                    for w in best:
                        w.add(score, ids, rows)
            for a, *_, best in asked:
                out += [pd.DataFrame({"anchor_row": a.row, "window": n, "row": w.row, "vec_id": w.id, "score": w.score})
                        for n, w in zip(a.window, best) if len(w.score)]
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: np.zeros(0, np.int64) for c in FOUND.split(", ")})
    return run


def _meet(blocks: DataFrame, groups: DataFrame, asked: DataFrame, chunks: int, dim: int, k: int, same: bool) -> DataFrame:
    """The first k rows of each (anchor, window); a group too short for an anchor's thresholds is not asked."""
    n = groups.agg(F.max("g")).first()[0]
    reach = F.sqrt(F.col("len2").cast("double")) * F.sqrt(F.col("longest").cast("double")) * (1 + SLACK)
    sent = (asked.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n or 0)))).join(groups, "g")
            .where(F.array_min("low") <= reach).withColumn("h", F.expr(f"pmod(xxhash64(row), {chunks})")))
    kept = blocks.withColumn("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    found = (kept.groupBy("g", "h").cogroup(sent.drop("len2", "longest").groupBy("g", "h"))
             .applyInPandas(_search(dim, k, same), FOUND))
    order = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(spark: SparkSession, vectors: DataFrame, anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 5,
         low: int = 80, high: int = 100) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row where ``anchor`` holds: its first ``positives`` other rows of
    the same label, and for each of them the first ``negatives`` rows of another
    label whose score is ``low`` to ``high`` hundredths of the positive's.
    """
    scratch = Scratch(spark, "lemp")
    rows = scratch.put(_scaled(vectors.select("vec_id", "embedding", "label", anchor.alias("is_anchor")),
                               F.col("is_anchor"), scale), "rows")
    total, dim, asked = rows.agg(F.count("*"), F.max(F.size("q")), F.count_if("anchor")).first()
    dim, chunks = max(1, dim or 0), max(1, -(-asked // ANCHOR_CHUNK))
    per_group = min(GROUP_ROWS[1], max(GROUP_ROWS[0], -(-total // SPREAD)))
    dealt = (rows.repartitionByRange(max(1, -(-total // per_group)), F.desc("len2"), "row")
             .sortWithinPartitions(F.desc("len2"), "row").withColumn("g", F.spark_partition_id()))
    blocks = scratch.put(dealt.select("g", "row", "vec_id", "label", "len2", "q").mapInArrow(_build(dim), BLOCKS), "blocks")
    groups = scratch.put(blocks.groupBy("g").agg(F.max("max_len2").alias("longest")), "groups")

    # a window that takes every score; its threshold is the running k-th best alone
    any_score = [F.array(F.lit(v)).alias(n) for n, v in (("window", 0), ("low", -EXACT), ("high", EXACT))]
    anchors = rows.where("anchor").drop("anchor")
    first = _meet(blocks, groups, anchors.select("row", "label", "q", "len2", *any_score), chunks, dim, positives, True)
    owner = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    pairs = scratch.put(first.join(owner, "anchor_row").select(
        "anchor_row", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "pairs")

    # a window for each different positive score of the anchor
    windows = (pairs.where("positive_score >= 0").groupBy(F.col("anchor_row").alias("row"))
               .agg(F.sort_array(F.collect_set("positive_score")).alias("window")))
    ends = anchors.join(windows, "row").select(
        "row", "label", "q", "len2", "window",
        F.expr(f"transform(window, s -> CAST((s * {low} + 99) DIV 100 AS DOUBLE))").alias("low"),
        F.expr(f"transform(window, s -> CAST(s * {high} DIV 100 AS DOUBLE))").alias("high"))
    second = _meet(blocks, groups, ends, chunks, dim, negatives, False)
    return (second.withColumnsRenamed({"window": "positive_score", "vec_id": "negative_id", "score": "negative_score"})
            .join(pairs, ["anchor_row", "positive_score"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
