"""N-gram Jaccard join by PartEnum signatures.

A document's set holds the 64-bit hashes of its distinct word shingles. Two
sets with Jaccard similarity of num/den or more differ in at most
k = (den - num) / (den + num) * (|x| + |y|) elements, and their sizes lie in
the same or in neighbouring size bands. For each of the two band instances of
a set the feature domain is partitioned by hash into n1 parts of n2 cells; two
sets that differ in at most k elements differ in at most K2 in one part, so
they agree on some subset of n2 - K2 of its cells. Each such subset is a
signature; every linked pair shares one.

Subsets with next to no elements would be shared by unrelated documents. So an
instance has ``spare`` more parts than needed: a linked pair then agrees in more
than ``spare`` parts, and a document with at most ``spare`` weak parts (parts
with a subset of fewer than ``least`` elements) leaves its weak subsets out: one
of the strong ones is shared. A document with more weak parts signs them all.
Shingles that a sample of documents shows to be frequent (licence lines, shared
passages) are left out of the signatures' domain: taking the same elements out
of both sets never makes them differ in more. A set that keeps too few elements
for strong subsets (a copy of a text that many documents copy) signs the strong
ones it has, by which it meets sets that are strong enough, and all its elements,
by which it meets others of its kind; so the empty rest that they all have in
common is no signature. Which ones are left out changes the number of
candidates, not the result; links are verified on whole sets.

Of documents with equal sets (two hashes and the size of the whole set agree) only the
smallest takes part in the steps below; the others are linked to it.
Rows sharing a signature are sorted together, never gathered: each member is
compared with the first one only (members of one slice of the input with the
slice's first one, which is compared with the signature's; such a signature
keeps its first one as a member). Verified links form components. Signatures
whose members still lie in different components are taken up again. Of these,
those with the same least member (by a hash) form one group with the members
of all of them, so a pair that shares hundreds of signatures meets in a few
groups. In a group every member outside the group's largest component meets all
members of other components: up to REFINE such members are held as a block, and
the group's rows stream past each block, sorted by component; a large group has
many blocks, which go to different tasks. Pairs are tested where they meet: by
the sets' sizes, by the shingles that no other candidate document holds (they
bound a document's intersection with any other and rule out most chance
candidates and heavily edited copies), and by an odd sketch (parities of
ODD * 64 hash buckets: each differing element flips one bit, so the differing
bits never exceed the sets' difference), folded first, then whole, and by element
counts of SKETCH hash buckets (their total difference never exceeds the sets'
difference). Of the pairs that pass, a member offers the first ``tries`` of each other component; one link
is enough to join the two. A group in which there were more is taken up again
with GROWTH times as many tries, unless the links found meanwhile have joined
its members; rounds end when nothing was held back. A pair offered is verified
on the whole sets. Nothing is capped and no pair is lost.

Defined cases: null and empty texts and texts without words have an empty set
and link with nothing; texts with fewer words than the shingle width have one
shingle, the whole sequence; rows that repeat a doc_id get equal results; a
null doc_id links with nothing (its component is null); an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch, TextBatch, components, mix64, trimmed, word_hashes

N2, K2 = 3, 1            # cells per part, differing cells tolerated
SUBSETS = ((0, 1), (0, 2), (1, 2))
REFINE = 2048        # members outside a group's largest component that a task holds while the group passes by
TRIES = 64           # pairs that such a member offers for each other component in the first round
GROWTH = 64          # their growth from round to round
TILE = 1 << 18       # pairs that are looked at together
SKETCH = 256
ODD = 32             # 64-bit words of the odd sketch
FOLD = 8             # words to which it is folded for the first look
SAMPLE_DOCS = 4_000      # expected documents of the sample that shows frequent shingles
FREQUENT = 6            # its documents (different sets) from which a shingle counts as frequent
MAX_FREQUENT = 50_000    # the most frequent ones; they travel with the tasks
COMBINE_BYTES = 4 << 20  # text whose equal signatures are combined before the shuffle

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingles(raw: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of one text's bytes."""
    words = word_hashes(LOWER[raw])
    if not len(words):
        return words
    n = min(width, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        h = mix64(h * _C[0] + words[j:len(words) - n + 1 + j])
    return np.unique(h)


# ------------------------------------------------------------------ signatures
class Scheme:
    """Size bands and signatures for similarity num/den."""

    def __init__(self, num: int, den: int, seed: int = 0, common: np.ndarray | None = None) -> None:
        self.num, self.den, self.seed = num, den, seed
        self.common = common if common is not None and len(common) else None
        self._layouts: dict[int, tuple[int, int, int]] = {}
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(self.low[-1] * den // num + 1)

    def band(self, size: int) -> int:
        return bisect_right(self.low, size) - 1

    def distance(self, instance: int) -> int:
        """The most elements in which linked sets can differ that meet in an instance.

        Instance j has the bands j - 1 and j; two sets of band j meet in instance j + 1.
        """
        sizes = self.low[instance + 1] - 1 + (self.low[instance] - 1 if instance else 0)
        return sizes * (self.den - self.num) // (self.den + self.num)

    def layout(self, instance: int) -> tuple[int, int, int]:
        """(parts, spare parts, least elements of a strong subset) of an instance."""
        if instance not in self._layouts:
            need = -(-(self.distance(instance) + 1) // (K2 + 1))
            out = (need, 0, 0)
            for least in (3, 2, 1):
                mean = self.low[instance] * (N2 - K2) / N2 / (need * 1.2)   # elements of a subset
                weak = len(SUBSETS) * sum(math.exp(-mean) * mean ** i / math.factorial(i) for i in range(least))
                if weak <= 0.12:
                    spare = math.ceil(1.5 * weak * need) + 1
                    out = (need + spare, spare, least)
                    break
            self._layouts[instance] = out
        return self._layouts[instance]

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        """All signatures of a set, for its own band's instance and the next one."""
        band = self.band(len(elements))
        rare = elements
        if self.common is not None:
            at = np.minimum(np.searchsorted(self.common, elements), len(self.common) - 1)
            rare = elements[self.common[at] != elements]
        return np.concatenate([self._instance(elements, rare, j) for j in (band, band + 1)])

    def _instance(self, elements: np.ndarray, rare: np.ndarray, instance: int) -> np.ndarray:
        tag = (instance * 0x1F123BB5 + self.seed * 0x5851F42D4C957F2D + 1) % (1 << 64)
        if self.distance(instance) == 0:
            return mix64(np.array([elements.sum(dtype=np.uint64)], np.uint64) * _C[1] + np.uint64(tag))
        n1, spare, least = self.layout(instance)
        if least and len(rare) < len(elements):
            few, strong = self._subsets(rare, n1, least, tag)
            if few <= spare:
                return strong[0]
            # sets with too few rare elements meet each other by all their elements, and the others by the strong subsets
            more, (some, every) = self._subsets(elements, n1, least, tag)
            return np.union1d(strong[0], some if more <= spare else every)
        few, (some, every) = self._subsets(elements, n1, least, tag)
        return some if few <= spare else every

    def _subsets(self, elements: np.ndarray, n1: int, least: int, tag: int) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
        """(weak parts, (signatures of the strong subsets, signatures of all subsets))."""
        h = mix64(elements * _C[2] + np.uint64(tag))
        cell = (((h >> np.uint64(34)) % np.uint64(n1)) * np.uint64(N2) + (h & np.uint64(0xFFFFFFFF)) % np.uint64(N2))
        cell = cell.astype(np.int64)
        sums = np.zeros(n1 * N2, np.uint64)
        np.add.at(sums, cell, mix64(h + _C[3]))
        sums = mix64(sums).reshape(n1, N2)
        count = np.bincount(cell, minlength=n1 * N2).reshape(n1, N2)
        part = np.arange(n1, dtype=np.uint64) * _C[0]
        sigs = np.stack([mix64(sums[:, a] * _C[1] + sums[:, b] + part + np.uint64(tag * (i + 1) % (1 << 64)))
                         for i, (a, b) in enumerate(SUBSETS)])
        strong = np.stack([count[:, a] + count[:, b] >= least for a, b in SUBSETS])
        return int((~strong.all(0)).sum()), (sigs[strong], sigs.ravel())


def _combined(sig: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (signature, document, leader, has leader): within the block a repeated signature keeps one free row.

    A free row with other rows behind it is its own leader.
    """
    order = np.lexsort((doc, sig))
    sig, doc = sig[order], doc[order]
    first = np.concatenate([[True], sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, bool)
    lead = doc[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))] if len(sig) else doc
    behind = lead != doc
    followed = np.concatenate([np.bincount(np.cumsum(first) - 1, behind) > 0, [False]])[np.cumsum(first) - 1]
    keep = first | behind
    return sig[keep], doc[keep], lead[keep], (behind | followed)[keep]


ROWS = "sig long, doc_id long, via long, size long"


def _sign_batches(scheme: Scheme, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, ids = TextBatch(b.column(1)), b.column(0)
            known = np.array(ids.is_valid())
            number = np.array(ids.fill_null(0))
            for lo, hi in text.slices(COMBINE_BYTES):
                sizes, keys, sigs, docs = [], [], [], []
                for i in range(lo, hi):
                    u = shingles(text.data[text.offsets[i]:text.offsets[i + 1]], width)
                    sizes.append(len(u))
                    keys.append([mix64(u * _C[1]).sum(dtype=np.uint64), mix64(u * _C[3]).sum(dtype=np.uint64)])
                    if len(u) and known[i]:
                        s = scheme.signatures(u).astype(np.int64)
                        sigs.append(s)
                        docs.append(np.full(len(s), number[i], np.int64))
                # one row per document with its set's size and two hashes of the whole set
                key = np.array(keys, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key[:, 0]), ids.slice(lo, hi - lo), pa.array(key[:, 1]),
                                                  pa.array(sizes, pa.int64())], names=["sig", "doc_id", "via", "size"])
                if sigs:
                    sig, doc, lead, has = _combined(np.concatenate(sigs), np.concatenate(docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig), pa.array(doc), pa.array(lead, mask=~has), pa.nulls(len(sig), pa.int64())],
                        names=["sig", "doc_id", "via", "size"])
    return run


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by signature -> (sig, a = its first document, b), and the size rows as they are.

    A first document that does not meet the rows behind another free one comes as a pair with itself, too.
    """
    last_sig, last_lead = None, None
    for b in batches:
        sig_col, doc_col, via_col, size_col = (b.column(i) for i in range(4))
        meta = np.array(size_col.is_valid())
        if meta.any():
            m = pa.array(meta)
            yield pa.RecordBatch.from_arrays([c.filter(m) for c in (sig_col, doc_col, via_col, size_col)],
                                             names=["sig", "a", "b", "size"])
        own = np.array(pc.equal(via_col, doc_col).fill_null(False))       # free rows that others stand behind
        local = np.array(via_col.is_valid()) & ~meta & ~own
        free = ~local & ~meta
        out = []
        if local.any():
            out.append((np.array(sig_col.fill_null(0))[local], np.array(via_col.fill_null(0))[local],
                        np.array(doc_col.fill_null(0))[local]))
        if free.any():
            sig, doc = np.array(sig_col.fill_null(0))[free], np.array(doc_col.fill_null(0))[free]
            first = np.concatenate([[sig[0] != last_sig], sig[1:] != sig[:-1]])
            at = np.maximum.accumulate(np.where(first, np.arange(len(sig)), -1))
            lead = np.where(at >= 0, doc[np.maximum(at, 0)], last_lead if last_lead is not None else 0)
            last_sig, last_lead = sig[-1], lead[-1]
            pair = ~first & (lead != doc)
            out.append((sig[pair], lead[pair], doc[pair]))
            stays = pair & own[free]
            out.append((sig[stays], lead[stays], lead[stays]))
        for sig, lead, doc in out:
            if len(sig):
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(lead), pa.array(doc),
                                                  pa.nulls(len(sig), pa.int64())], names=["sig", "a", "b", "size"])


def pair_up(rows: DataFrame) -> DataFrame:
    """(sig, a, b, size) from signature rows: one shuffle, a sort, and a scan that holds one row.

    Rows that already have a leader travel by their document, so a signature
    that a third of all rows share does not meet in one task.
    """
    free = F.col("size").isNull() & (F.col("via").isNull() | (F.col("via") == F.col("doc_id")))
    key = F.coalesce(F.when(free, F.col("sig")), F.col("doc_id"))
    return (rows.repartition(key).sortWithinPartitions("sig", "doc_id")
            .mapInArrow(trimmed(_pair_batches), "sig long, a long, b long, size long"))


# ---------------------------------------------------------------- verification
def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, shingles) with the sorted distinct hashes as an array."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = TextBatch(b.column(1))
            for lo, hi in text.slices():
                sets = [shingles(text.data[text.offsets[i]:text.offsets[i + 1]], width).astype(np.int64)
                        for i in range(lo, hi)]
                ends = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
                    names=["doc_id", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(trimmed(run), "doc_id long, shingles array<long>")


def frequent_shingles(docs: DataFrame, width: int) -> np.ndarray:
    """Sorted hashes of the shingles that many documents of a bounded sample hold; copies count once."""
    share = min(1.0, SAMPLE_DOCS / max(docs.count(), 1))
    rank = (F.xxhash64("doc_id", F.lit(61)).cast("double") / 9223372036854775807 + 1.0) / 2.0
    sets = shingle_sets(docs.where(rank <= share), width).groupBy(F.xxhash64("shingles").alias("k")).agg(
        F.first("shingles").alias("shingles"))
    rows = (sets.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n"))
            .where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "s").limit(MAX_FREQUENT).select("s").toPandas())
    return np.sort(rows["s"].to_numpy(np.int64).astype(np.uint64))


def _sketch(sets: DataFrame) -> DataFrame:
    """(doc_id, size, odd, sketch): the parities of ODD * 64 hash buckets as bytes, and element counts of SKETCH other
    buckets, at most 255 each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, odd, out = [], [], []
            for s in b.column(1):
                h = s.values.to_numpy(zero_copy_only=False).view(np.uint64)
                sizes.append(len(h))
                bit = ((h >> np.uint64(20)) % np.uint64(ODD * 64)).astype(np.int64)
                odd.append(np.packbits(np.bincount(bit, minlength=ODD * 64).astype(np.uint8) & 1).tobytes())
                bucket = (h % np.uint64(SKETCH)).astype(np.int64)
                out.append(np.minimum(np.bincount(bucket, minlength=SKETCH), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(odd, pa.binary()), pa.array(out, pa.binary())],
                names=["doc_id", "size", "odd", "sketch"])

    return sets.mapInArrow(trimmed(run), "doc_id long, size long, odd binary, sketch binary")


def _words(column: pa.Array) -> np.ndarray:
    """The odd sketches of a column, a row of words each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), ODD)


def _folded(odd: np.ndarray) -> np.ndarray:
    """Odd sketches with fewer buckets."""
    return np.bitwise_xor.reduce(odd.reshape(len(odd), ODD // FOLD, FOLD), axis=1)


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits, row by row."""
    return np.bitwise_count(x ^ y).sum(1, dtype=np.int64)


def _counts(column: pa.Array) -> np.ndarray:
    """The element counts of a column, a row of buckets each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), SKETCH)


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Total difference of element counts, row by row."""
    return np.abs(x.astype(np.int16) - y.astype(np.int16)).sum(1, dtype=np.int64)


def _near_batches(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = b.column(2).to_numpy() + b.column(5).to_numpy()
            ok = np.flatnonzero(_differing(_words(b.column(3)), _words(b.column(6))) * (den + num) <= total * (den - num))
            x, y = (_counts(b.column(i).take(pa.array(ok))) for i in (4, 7))
            ok = pa.array(ok[_apart(x, y) * (den + num) <= total[ok] * (den - num)])
            yield pa.RecordBatch.from_arrays([b.column(0).take(ok), b.column(1).take(ok)], names=["a", "b"])
    return run


def scalars(sets: DataFrame, num: int, den: int) -> DataFrame:
    """(doc_id, size, most, odd, sketch) of the sets that can link at all; most: shingles that another document holds, too.

    An intersection has at most ``most`` elements, so a document needs den * most >= num * size. A repeated doc_id has
    a row for each of its sets, with most = size.
    """
    own = (sets.select("doc_id", F.explode("shingles").alias("x")).groupBy("x")
           .agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")).where("doc_id = last")
           .selectExpr("doc_id", "1L AS own", "0L AS n"))
    own = (own.union(sets.selectExpr("doc_id", "0L AS own", "1L AS n")).groupBy("doc_id").agg(F.sum("own").alias("own"), F.sum("n").alias("n"))
           .select("doc_id", F.when(F.col("n") == 1, F.col("own")).otherwise(0).alias("own")))
    return (own.join(_sketch(sets), "doc_id").where((F.col("size") - F.col("own")) * den >= F.col("size") * num)
            .select("doc_id", "size", (F.col("size") - F.col("own")).alias("most"), "odd", "sketch"))


def likely(pairs: DataFrame, able: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of ``pairs(a, b)`` whose sizes and sketches allow a link."""
    ka, kb = able.toDF("a", "na", "ma", "oa", "xa"), able.toDF("b", "nb", "mb", "ob", "xb")
    most = F.least("ma", "mb")
    return (pairs.join(ka, "a").join(kb, "b").where(most * den >= (F.col("na") + F.col("nb") - most) * num)
            .select("a", "b", "na", "oa", "xa", "nb", "ob", "xb")
            .mapInArrow(trimmed(_near_batches(num, den)), "a long, b long"))


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of the written table ``pairs(a, b)`` whose sets have den * |intersection| >= num * |union|."""
    # a written list of ids has a known size: Spark broadcasts a short one, and only the sets needed are shuffled
    left = sets.join(pairs.select(F.col("a").alias("doc_id")), "doc_id", "left_semi").toDF("a", "sa")
    right = sets.join(pairs.select(F.col("b").alias("doc_id")), "doc_id", "left_semi").toDF("b", "sb")
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(both * den >= (F.size("sa") + F.size("sb") - both) * num).select("a", "b"))


# ------------------------------------------------------------- members of a group
class Block:
    """Members of one group held by a task, and what they have offered to the component that passes by."""

    def __init__(self, num: int, den: int, tries: int) -> None:
        self.num, self.den, self.tries = num, den, tries
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.whole: tuple[np.ndarray, ...] | None = None
        self.offered, self.to, self.more = np.zeros(0, np.int64), None, False

    def hold(self, rows: tuple[np.ndarray, ...]) -> None:
        self.parts.append(rows)

    def meet(self, rows: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (held, passing) of documents that may link; ``rows`` come sorted by component."""
        if self.whole is None:
            if not self.parts:
                return
            self.whole = tuple(np.concatenate(x) for x in zip(*self.parts))
            self.offered = np.zeros(len(self.whole[0]), np.int64)
        step = max(1, TILE // len(self.whole[0]))
        for lo in range(0, len(rows[0]), step):
            yield self._tile(tuple(x[lo:lo + step] for x in rows))

    def _tile(self, rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        doc, comp, _, size, most, odd, fold, count = self.whole
        doc2, comp2, top2, size2, most2, odd2, fold2, count2 = rows
        num, den = self.num, self.den
        differ = np.zeros((len(doc2), len(doc)), np.uint16)
        for w in range(FOLD):
            differ += np.bitwise_count(fold2[:, w, None] ^ fold[None, :, w])
        # of two members outside the largest component only the smaller one offers
        ok = (differ.astype(np.int64) * (den + num) <= (size2[:, None] + size) * (den - num)) & (comp2[:, None] != comp)
        m, h = np.nonzero(ok & (top2[:, None] | (doc2[:, None] > doc)))
        least, total = np.minimum(most2[m], most[h]), size2[m] + size[h]
        ok = least * den >= (total - least) * num
        m, h, total = m[ok], h[ok], total[ok]
        ok = _differing(odd2[m], odd[h]) * (den + num) <= total * (den - num)
        m, h, total = m[ok], h[ok], total[ok]
        ok = _apart(count2[m], count[h]) * (den + num) <= total * (den - num)
        m, h = m[ok], h[ok]
        # the how manyeth offer of a held member to a component; one component may pass in several tiles
        order = np.lexsort((m, comp2[m], h))
        m, h = m[order], h[order]
        first = np.ones(len(m), bool)
        first[1:] = (h[1:] != h[:-1]) | (comp2[m[1:]] != comp2[m[:-1]])
        rank = np.arange(len(m)) - np.maximum.accumulate(np.where(first, np.arange(len(m)), 0))
        rank += np.where(comp2[m] == self.to, self.offered[h], 0) if self.to is not None else 0
        last = comp2[-1]
        if self.to is None or last != self.to:
            self.offered[:] = 0
            self.to = last
        ends = comp2[m] == last
        np.maximum.at(self.offered, h[ends], rank[ends] + 1)
        keep = rank < self.tries
        self.more |= not keep.all()
        return doc[h[keep]], doc2[m[keep]]


def _meet_batches(num: int, den: int, tries: int):
    """Rows sorted by (sig, block, held first, comp) -> pairs (sig, a, b), and (sig, null, null) where there are more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, block = None, None
        for b in batches:
            sig, part, passing, doc, comp, top, size, most = (b.column(i).to_numpy(zero_copy_only=False) for i in range(8))
            odd = _words(b.column(8))
            rows = (doc, comp, top, size, most, odd, _folded(odd), _counts(b.column(9)))
            cut = (sig[1:] != sig[:-1]) | (part[1:] != part[:-1]) | (passing[1:] != passing[:-1])
            edges = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(sig)]])
            sigs, xs, ys, more = [], [], [], []
            for lo, hi in zip(edges[:-1], edges[1:]):
                if (sig[lo], part[lo]) != at:
                    at, block = (sig[lo], part[lo]), Block(num, den, tries)
                run_ = tuple(x[lo:hi] for x in rows)
                if not passing[lo]:
                    block.hold(run_)
                    continue
                before = block.more
                for x, y in block.meet(run_):
                    sigs.append(np.full(len(x), sig[lo]))
                    xs.append(np.minimum(x, y))
                    ys.append(np.maximum(x, y))
                if block.more and not before:
                    more.append(sig[lo])
            if xs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (sigs, xs, ys)], names=["sig", "a", "b"])
            if more:
                none = pa.nulls(len(more), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.array(more, np.int64)), none, none], names=["sig", "a", "b"])
    return run


def meetings(rest: DataFrame, able: DataFrame, num: int, den: int, tries: int) -> DataFrame:
    """(sig, a, b) from a group's rows (sig, doc_id, comp, outside, top): see the module's text."""
    blocks = F.ceil(F.col("outside") / REFINE).cast("int")
    outer = F.col("comp") != F.col("top")
    rows = (rest.select("sig", "doc_id", "comp", (~outer).alias("in_top"), blocks.alias("blocks"))
            .join(able, "doc_id"))
    held = (rows.where("NOT in_top")
            .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("blocks")).cast("int"))
            .withColumn("passing", F.lit(False)))
    passing = (rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .withColumn("passing", F.lit(True)))
    columns = ["sig", "block", "passing", "doc_id", "comp", "in_top", "size", "most", "odd", "sketch"]
    return (held.select(columns).union(passing.select(columns)).repartition("sig", "block")
            .sortWithinPartitions("sig", "block", "passing", "comp", "doc_id")
            .mapInArrow(trimmed(_meet_batches(num, den, tries)), "sig long, a long, b long"))


# -------------------------------------------------------------------- equal sets
def equal_sets(scratch: Scratch, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, rep) of the documents with a set that a smaller document holds, too (rep: the smallest that does),
    and those rows of documents that are one row of the input: a repeated doc_id may have other sets besides."""
    key = ["k1", "k2", "n_shingles"]
    held = meta.where("n_shingles > 0 AND doc_id IS NOT NULL")
    several = scratch.put(held.groupBy(key).agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
                          .where("rep < last").drop("last"), "several")
    equal = scratch.put(held.join(several, key).where("rep < doc_id").select("doc_id", "rep"), "equal")
    repeated = scratch.put(held.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    return equal, equal.join(repeated, "doc_id", "left_anti")


# -------------------------------------------------------------------- operator
def jaccard_components(spark: SparkSession, docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    scratch = Scratch(spark, "partenum")
    scheme = Scheme(num, den, 0, frequent_shingles(docs, width))
    rows = docs.select("doc_id", "text").mapInArrow(trimmed(_sign_batches(scheme, width)), ROWS)
    found = scratch.put(pair_up(rows), "found")
    meta = scratch.put(found.where("size IS NOT NULL").select(F.col("a").alias("doc_id"), F.col("size").alias("n_shingles"),
                                                              F.col("sig").alias("k1"), F.col("b").alias("k2")), "meta")
    # of documents with equal sets only the smallest goes on; it has all their signatures
    equal, copies = equal_sets(scratch, meta)
    pairs = scratch.put(found.where("size IS NULL").select("sig", "a", "b")
                        .join(copies.select(F.col("doc_id").alias("b")), "b", "left_anti"), "signed")
    scratch.drop("found")

    # the round's pairs are (first member of a signature, other); first ones that have then met all others leave
    todo = (pairs.select("a", "b").distinct().join(copies.select(F.col("doc_id").alias("a"), "rep"), "a", "left")
            .select(F.coalesce("rep", "a").alias("a"), "b").where("a <> b"))
    todo = scratch.put(todo.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs0")
    ids = scratch.put(todo.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "ids")
    sets = scratch.put(shingle_sets(docs.select("doc_id", "text").join(ids, "doc_id", "left_semi"), width), "sets")
    able = scratch.put(scalars(sets, num, den), "able")
    members = scratch.put(pairs.join(able.select(F.col("doc_id").alias("b")), "b", "left_semi")
                          .select("sig", F.col("b").alias("doc_id")).distinct(), "members0")
    links = scratch.put(verified(scratch.put(likely(todo, able, num, den), "likely0"), sets, num, den)
                        .union(equal.select("rep", "doc_id")), "links0")
    for done in ("signed", "pairs0", "likely0", "ids", "several", "equal", "repeated"):
        scratch.drop(done)
    comp, step, tries = components(spark, Scratch(spark, "partenum-cc"), links), 0, TRIES
    while True:
        step += 1
        placed = (members.join(comp, members.doc_id == comp.node, "left")
                  .select("sig", "doc_id", F.coalesce("component", "doc_id").alias("comp")))
        # signatures with members in several components; those with the same least member (by a hash) become one group:
        # the copies of a text share very many signatures, and a pair is to meet in one group, not in each of them
        split = (placed.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high"),
                                           F.min(F.xxhash64("doc_id")).alias("group"))
                 .where("low < high").select("sig", "group"))
        grouped = scratch.put(placed.join(split, "sig").select(F.col("group").alias("sig"), "doc_id", "comp").distinct(),
                              f"grouped{step}")
        top = (grouped.groupBy("sig", "comp").agg(F.count("*").alias("n"))
               .groupBy("sig").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
               .select("sig", (F.col("n") - F.col("top.n")).alias("outside"), F.col("top.comp").alias("top")))
        met = scratch.put(meetings(grouped.join(top, "sig"), able, num, den, tries), f"met{step}")
        near = scratch.put(met.where("a IS NOT NULL").select("a", "b").distinct(), f"likely{step}")
        new = scratch.put(verified(near, sets, num, den), f"new{step}")
        if not new.isEmpty():
            links = links.union(new)
            comp = components(spark, Scratch(spark, "partenum-cc"), links)
        more = met.where("a IS NULL").select("sig").distinct()
        if more.isEmpty():                    # all members outside the largest components have met the others
            break
        members = scratch.put(grouped.join(more, "sig", "left_semi").select("sig", "doc_id"), f"members{step}")
        for done in (f"grouped{step}", f"met{step}", f"likely{step}", f"members{step - 1}"):
            scratch.drop(done)
        tries *= GROWTH
    return (meta.join(comp, meta.doc_id == comp.node, "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def keep_one_each(spark: SparkSession, docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of ``docs`` without all but the smallest id of each component, all columns."""
    scratch = Scratch(spark, "partenum-keep")
    found = jaccard_components(spark, docs, width, num, den)
    drop = scratch.put(found.where("component_id <> doc_id").select("doc_id").distinct(), "drop")
    return docs.join(drop, "doc_id", "left_anti").select(docs.columns)
