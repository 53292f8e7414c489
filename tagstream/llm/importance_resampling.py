"""Quality classifier by importance resampling.

Two hashed n-gram generative models, one of target text (documents labelled
good) and one of the raw corpus (all documents), give every document the log
importance weight  sum over its n-grams of log p_target - log p_raw. Documents
are drawn without replacement by Gumbel top-k: key = weight / temperature +
Gumbel noise seeded by the document's id, the k largest keys stay. k is the
number of documents whose weight exceeds a cut fitted on labelled documents,
so the draw keeps as many as the classifier accepts, and the noise only
decides between documents right at the cut.

The n-grams are taken over two views of the whole text: 4-grams of characters
folded to classes (lower case and non-ASCII letters, upper case, digits;
punctuation and white space stay), and pairs of neighbouring words written as
the distance (up to 8 words) back to their last repeat.

Defined cases: a null or empty text has weight 0; rows that repeat an id draw
the same noise; keys equal to the k-th largest all stay; a document labelled
twice counts as good if any label says so; without labelled good documents all
weights are 0 and everything stays; an empty table gives an empty result;
only doc_id and text are read, other columns pass through ``keep_sampled``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tagstream.llm.common import Scratch, TextBatch, word_hashes

BUCKETS = 1 << 16       # hash buckets of the two models (the only thing that reaches the driver)
LABEL_SAMPLE = 8192     # labelled documents that fit the target model and the cut, at most
TEMPERATURE = 0.05
SEED = 29
SELECT_BINS = 4096      # histogram bins of one round of the k-th key search

GRAM, REPEAT = 4, 8

def _fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[ord("a"):ord("z") + 1] = ord("a")
    t[128:] = ord("a")
    t[ord("A"):ord("Z") + 1] = ord("A")
    t[ord("0"):ord("9") + 1] = ord("0")
    t[[9, 11, 12, 13]] = 32
    return t


FOLD = _fold_table()


def _hashed(seq: np.ndarray, n: int, salt: int) -> np.ndarray:
    if len(seq) < n:
        return np.zeros(0, np.int64)
    h = np.full(len(seq) - n + 1, salt, np.uint64)
    for j in range(n):
        h = (h ^ seq[j:len(seq) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def features(raw: np.ndarray) -> np.ndarray:
    """The bucket of every n-gram of one text's bytes."""
    chars = _hashed(FOLD[raw].astype(np.uint64), GRAM, 1)
    words = word_hashes(raw)
    back = np.zeros(len(words), np.uint64)
    for k in range(min(REPEAT, len(words) - 1), 0, -1):
        back[k:][words[k:] == words[:-k]] = k
    return np.concatenate([chars, _hashed(back, 2, 7)])


# --------------------------------------------------------------------- models
def label_sample(labels: DataFrame, bound: int = LABEL_SAMPLE) -> DataFrame:
    """At most ``bound`` labelled ids (doc_id, good), the smallest by a hash of the id."""
    rated = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("good"))
    share = min(1.0, 1.2 * bound / max(rated.count(), 1) + 0.01)
    order = F.xxhash64("doc_id", F.lit(SEED))
    below = (2.0 * share - 1.0) * 9223372036854775807
    return rated.where(order.cast("double") <= below).orderBy(order, "doc_id").limit(bound)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        text, good = TextBatch(b.column(0)), b.column(1).to_pylist()
        for i in range(text.n):
            n = np.bincount(features(text.data[text.offsets[i]:text.offsets[i + 1]]), minlength=BUCKETS)
            raw += n
            if good[i] == 1:
                target += n
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(raw[seen]), pa.array(target[seen])],
                                     names=["bucket", "n_raw", "n_target"])


def fit_ratio(docs: DataFrame, sample: DataFrame) -> np.ndarray:
    """log p_target - log p_raw per bucket, counted over all documents."""
    rows = (docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "good")
            .mapInArrow(_count_batches, "bucket long, n_raw long, n_target long")
            .groupBy("bucket").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target")).toPandas())
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["n_raw"], rows["n_target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    ratio = np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    ratio[raw == 0] = 0.0
    return ratio


def weight_of(ratio: np.ndarray):
    """A column function text -> log importance weight."""
    ratio = ratio.astype(np.float64)

    @arrow_udf("double")
    def weight(text: pa.Array) -> pa.Array:
        t = TextBatch(text)
        return pa.array([round(float(ratio[features(t.data[t.offsets[i]:t.offsets[i + 1]])].sum()), 9)
                         for i in range(t.n)], pa.float64())

    return weight


def fit_cut(scored: DataFrame, sample: DataFrame) -> float:
    """The weight above which a document counts as good.

    Fewest labelled documents (at most LABEL_SAMPLE) on the wrong side, the
    lowest such place on ties, in the middle between two labelled weights.
    """
    rows = sorted((r["weight"], r["good"] == 1) for r in scored.join(F.broadcast(sample), "doc_id")
                  .groupBy("doc_id").agg(F.max("weight").alias("weight"), F.max("good").alias("good")).collect())
    wrong = best = sum(not good for _, good in rows)
    cut = float("-inf")
    for i, (weight, good) in enumerate(rows):
        wrong += 1 if good else -1
        after = rows[i + 1][0] if i + 1 < len(rows) else float("inf")
        if wrong < best and after > weight:
            best, cut = wrong, (weight + after) / 2 if i + 1 < len(rows) else weight
    return cut


# ------------------------------------------------------------------- sampling
def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / float(1 << 53)))


def sample_key(weight: Column, doc_id: Column) -> Column:
    return weight / F.lit(TEMPERATURE) + gumbel(doc_id)


def kth_largest(keys: DataFrame, k: int) -> float:
    """The k-th largest value of the column ``key``, by histograms of shrinking ranges; nothing is sorted globally."""
    lo, hi, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or not n:
        return float("inf")
    if k >= n:
        return float("-inf")
    while True:
        inside = keys.where((F.col("key") >= lo) & (F.col("key") <= hi))
        width = (hi - lo) / SELECT_BINS
        if n <= SELECT_BINS or width <= 0 or lo + width == lo:
            last = inside.groupBy("key").count().orderBy(F.desc("key")).take(SELECT_BINS)
            for r in last:
                k -= r["count"]
                if k <= 0:
                    return r["key"]
            return lo
        b = F.least(F.floor((F.col("key") - F.lit(lo)) / F.lit(width)), F.lit(SELECT_BINS - 1))
        rows = (inside.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
                .orderBy(F.desc("bin")).collect())
        for r in rows:
            if k <= r["n"]:
                lo, hi, n = r["lo"], r["hi"], r["n"]
                break
            k -= r["n"]


class Model:
    """What the fit leaves: the ratio table, the cut and the smallest key that stays."""

    def __init__(self, ratio: np.ndarray, cut: float, k: int, least_key: float) -> None:
        self.ratio, self.cut, self.k, self.least_key = ratio, cut, k, least_key

    def decide(self, weight: Column, doc_id: Column) -> Column:
        return sample_key(weight, doc_id) >= F.lit(self.least_key)


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, Model]:
    """(doc_id, weight) of every row as a written table, and the fitted model."""
    scratch = Scratch(spark, "importance")
    sample = scratch.put(label_sample(labels).coalesce(1), "sample")
    ratio = fit_ratio(docs, sample)
    scored = scratch.put(docs.select("doc_id", weight_of(ratio)("text").alias("weight")), "scored")
    cut = fit_cut(scored, sample)
    k = scored.where(F.col("weight") > F.lit(cut)).count()
    keys = scored.select(sample_key(F.col("weight"), F.col("doc_id")).alias("key"))
    return scored, Model(ratio, cut, k, kth_largest(keys, k))


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, weight, key, kept."""
    scored, model = score(spark, docs, labels)
    w, i = F.col("weight"), F.col("doc_id")
    return scored.select("doc_id", "weight", sample_key(w, i).alias("key"), model.decide(w, i).alias("kept"))


def keep_sampled(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the draw keeps, all columns; the weight is computed in the scan, so no text is shuffled."""
    _, model = score(spark, docs, labels)
    return docs.where(model.decide(weight_of(model.ratio)(F.col("text")), F.col("doc_id")))
