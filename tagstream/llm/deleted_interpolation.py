"""LM scoring: a bigram model with deleted interpolation.

P(w | v) = l2 * c(v w) / c(v) + l1 * c(w) / N + l0 / (V + 1). The weights differ
by the frequency of the context v (buckets of powers of two). They are learned by
expectation-maximisation on held-out counts: the training documents' ``tune``
part is deleted from the counts, and the weights that give its bigrams the
highest likelihood under the remaining counts are kept. The final model uses
the counts of all training documents.

Texts are read once, into slices of bounded size: the words of a slice and its
tokens as numbers of these words. A slice asks for each of its different words
and bigrams once, as sorted 64-bit hashes cut by hash range, so what travels is
one short entry per different n-gram of a slice, not per token. Each range sums
its counts over all slices and answers every slice with a vector in the order in
which it asked, holding only what other slices counted. No slice, range or n-gram
is ever gathered beyond its bound; a text longer than a slice runs through
several of them.

Defined cases: a null text is empty, its only token is the end; a null doc_id is
not learned from and not held out; a row is a document, so repeated rows are
counted and scored each; without training documents every count is 0, so each
token has probability 1 / (V + 1) with V = 0; an empty table gives no rows;
other columns are not read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import SPACES, Scratch, TextBatch, mix64, release, trimmed, word_hashes

SLICE_TOKENS = 1 << 20               # tokens of a slice
READ_BYTES = 2 << 20                 # text bytes tokenised at once
RANGE_ENTRIES = 1 << 19              # expected entries of a hash range
CONTEXTS = 48                        # frequency buckets: 0, 1, 2-3, 4-7, ...
ROUNDS, CLOSE = 20, 1e-3             # EM rounds at most, and the change of a weight that ends them
WORD, PAIR = 1, 2
START, END = (mix64(np.array([k], np.uint64))[0] for k in (11, 13))
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


# ---------------------------------------------------------------------- packing
def _pack(a: np.ndarray) -> bytes:
    """Byte planes of an array, compressed: small numbers take about their significant bytes."""
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T) if len(a) else np.zeros(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel() if len(raw) else np.zeros(0, dtype)


def _pack_sorted(a: np.ndarray) -> bytes:
    return _pack(np.diff(a, prepend=np.zeros(1, a.dtype)))


def _unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(_unpack(b, np.uint64), dtype=np.uint64)


# ----------------------------------------------------------------------- slices
# A slice is a stream of words of pieces of documents. The first word of a piece is
# context only: the start mark, or the word before when a document goes on.
SLICES = "slice long, n_words long, n_tokens long, words binary, codes binary, pieces binary"
PIECE = np.dtype([("row", "i8"), ("doc_id", "i8"), ("null_id", "u1"), ("held", "u1"), ("train", "u1"), ("tune", "u1"), ("len", "i8")])


def _documents(text: TextBatch, read: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first document, past the last one, hashes, document of each hash) of runs of documents; the end mark counts as a word.

    A text above ``read`` bytes comes in several runs of one document, only the last of them with the end mark.
    """
    for lo, hi in text.slices(read):
        base, end = text.offsets[lo], text.offsets[hi]
        if hi == lo + 1 and end - base > read:
            x, at = text.data[base:end], 0
            while at < len(x):
                stop = min(at + read, len(x))
                while stop < len(x) and not SPACES[x[stop]]:
                    step = SPACES[x[stop:stop + 4096]]
                    stop += int(step.argmax()) if step.any() else len(step)
                words = word_hashes(_LOWER[x[at:stop]])
                if stop == len(x):
                    words = np.append(words, END)
                yield lo, hi, words, np.full(len(words), lo)
                at = stop
            continue
        # one space after each document keeps its last word from the next one's first
        begin = text.offsets[lo:hi + 1] - base
        x = np.insert(_LOWER[text.data[base:end]], begin[1:], 32)
        stop = begin[1:] + np.arange(hi - lo)
        edge = np.diff(np.concatenate([[True], SPACES[x], [True]]).astype(np.int8))
        doc = np.searchsorted(stop, np.flatnonzero(edge == -1))
        n, k = len(doc), hi - lo
        place = np.concatenate([np.arange(n) + doc, np.searchsorted(doc, np.arange(k), side="right") + np.arange(k)])
        words, of = np.empty(n + k, np.uint64), np.empty(n + k, np.int64)
        words[place] = np.append(word_hashes(x), np.full(k, END))
        of[place] = lo + np.append(doc, np.arange(k))
        yield lo, hi, words, of


def _slice(number: int, words: list[np.ndarray], pieces: list[np.ndarray]) -> pa.RecordBatch:
    stream = np.concatenate(words)
    words.clear()
    known, codes = np.unique(np.append(stream, [START, END]), return_inverse=True)
    done = np.concatenate(pieces)
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([len(known)], pa.int64()), pa.array([len(stream)], pa.int64()),
         pa.array([_pack_sorted(known)], pa.binary()), pa.array([_pack(codes[:-2].astype(np.int32))], pa.binary()),
         pa.array([zstandard.compress(done.tobytes(), 1)], pa.binary())], names=[c.split()[0] for c in SLICES.split(", ")])


def _slicer(tokens: int, read: int):
    """part, doc_id, held, train, tune, text -> slices."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pieces, size, made, row, part = [], [], 0, 0, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(0)[0].as_py()
            ids = b.column(1)
            info = np.zeros(b.num_rows, PIECE)
            info["row"] = (part << 33) + row + np.arange(b.num_rows)
            info["doc_id"], info["null_id"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
            for k, c in enumerate(("held", "train", "tune"), 2):
                info[c] = b.column(k).to_numpy(zero_copy_only=False)
            row += b.num_rows
            last, before = -1, START
            for lo, hi, run, of in _documents(TextBatch(b.column(5)), read):
                starts = np.searchsorted(of, np.arange(lo, hi))
                lens = np.diff(np.append(starts, len(run)))
                context = np.full(hi - lo, START)
                if hi == lo + 1 and lo == last:
                    context[0] = before
                last, before = hi - 1, run[-1] if len(run) else before
                more = info[lo:hi].copy()
                more["len"] = lens + 1
                words.append(np.insert(run, starts, context))
                pieces.append(more)
                size += len(words[-1])
                if size >= tokens:
                    made += 1
                    whole, words, pieces, size = _slice((part << 32) + made, words, pieces), [], [], 0
                    release()
                    yield whole
        if size:
            yield _slice((part << 32) + made + 1, words, pieces)
    return run


class _Slice:
    """Words and counts of one slice."""

    def __init__(self, words: bytes, codes: bytes, pieces: bytes) -> None:
        self.words = _unpack_sorted(words)
        codes = _unpack(codes, np.int32).astype(np.int64)
        self.pieces = np.frombuffer(zstandard.decompress(pieces), PIECE)
        self.start, self.end = np.searchsorted(self.words, np.array([START, END]))
        lens = self.pieces["len"]
        first = np.cumsum(lens) - lens
        token = np.ones(len(codes), bool)
        token[first] = False
        at = np.flatnonzero(token)
        self.w, self.v = codes[at], codes[at - 1]
        self.piece = np.repeat(np.arange(len(lens)), lens - 1)
        n = len(self.words)
        self.word_counts = self._counts(self.w, n)
        # bigrams in the order of their hashes
        key, self.pair = np.unique(self.v * n + self.w, return_inverse=True)
        v, w = key // n, key % n
        hashes = mix64(self.words[v] * np.uint64(0x9E3779B97F4A7C15) + mix64(self.words[w]))
        order = np.argsort(hashes, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.pair, self.pairs, self.pair_v, self.pair_w = rank[self.pair], hashes[order], v[order], w[order]
        self.pair_counts = self._counts(self.pair, len(order))

    def _counts(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in training documents, and in their tune part."""
        return tuple(np.bincount(codes[self.pieces[c][self.piece] > 0], minlength=n).astype(np.int64) for c in ("train", "tune"))


# ----------------------------------------------------------------- counts by range
ASKED = "kind int, hash_range long, slice long, hashes binary, train binary, tune binary"
ANSWER = "slice long, kind int, hash_range long, train binary, tune binary, total long, tune_total long, different long"


def _ask(bits: dict[int, int]):
    """Each different word and bigram of a slice once, cut by the leading bits of its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for number, words, codes, pieces in zip(*(b.column(c).to_pylist() for c in ("slice", "words", "codes", "pieces"))):
                s = _Slice(words, codes, pieces)
                for kind, hashes, (train, tune) in ((WORD, s.words, s.word_counts), (PAIR, s.pairs, s.pair_counts)):
                    ranges = (hashes >> np.uint64(64 - bits[kind])).astype(np.int64) if bits[kind] else np.zeros(len(hashes), np.int64)
                    cuts = np.append(np.flatnonzero(np.diff(ranges, prepend=-1)), len(ranges))
                    cols = [[], [], [], []]
                    for lo, hi in zip(cuts[:-1], cuts[1:]):
                        for col, v in zip(cols, (int(ranges[lo]), _pack_sorted(hashes[lo:hi]), _pack(train[lo:hi].astype(np.int32)),
                                                 _pack(tune[lo:hi].astype(np.int32)))):
                            col.append(v)
                    n = len(cols[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * n, pa.int32()), pa.array(cols[0], pa.int64()), pa.array([number] * n, pa.int64()),
                         *[pa.array(c, pa.binary()) for c in cols[1:]]], names=[c.split()[0] for c in ASKED.split(", ")])
    return run


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums one range over all slices; each slice gets, in its order, what the others counted."""
    pdf = pdf.sort_values("slice")
    parts = [_unpack_sorted(x) for x in pdf["hashes"]]
    cuts = np.cumsum([0] + [len(p) for p in parts])
    _, code = np.unique(np.concatenate(parts), return_inverse=True)
    out = {"slice": pdf["slice"].to_numpy(), "kind": pdf["kind"].to_numpy(), "hash_range": pdf["hash_range"].to_numpy()}
    sums = {}
    for c in ("train", "tune"):
        own = np.concatenate([_unpack(x, np.int32) for x in pdf[c]]).astype(np.int64)
        sums[c] = total = np.zeros(code.max() + 1, np.int64)
        np.add.at(total, code, own)
        others = total[code] - own
        out[c] = [_pack(others[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])]
    head = np.zeros(len(pdf), np.int64)
    head[0] = 1                                          # the range's own figures stand in one row
    out |= {"total": head * sums["train"].sum(), "tune_total": head * sums["tune"].sum(), "different": head * (sums["train"] > 0).sum()}
    return pd.DataFrame(out)


def _totals(answers: pd.DataFrame, kind: int, own: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts over all slices of one slice's words or bigrams."""
    part = answers[answers["kind"] == kind].sort_values("hash_range")
    return tuple(np.concatenate([_unpack(x, np.int64) for x in part[c]]) + o for c, o in zip(("train", "tune"), own))


# ------------------------------------------------------------ weights by EM
TUNED = "context int, pair long, before long, word long, n long"
TUNE_PART = "slice long, arrays binary"
_TUNE_FIELDS = ("n", "pair", "pair_train", "v", "v_train", "v_tune", "w", "w_train", "w_tune")


def _tune_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each slice the bigrams of its tune documents: where they stand in its lists, and its own counts."""
    for b in batches:
        for number, words, codes, pieces in zip(*(b.column(c).to_pylist() for c in ("slice", "words", "codes", "pieces"))):
            s = _Slice(words, codes, pieces)
            at = np.flatnonzero(s.pair_counts[1])
            v, w = s.pair_v[at], s.pair_w[at]
            v = np.where(v == s.start, s.end, v)                  # a document's start occurs as often as its end
            (wt, wh), (pt, ph) = s.word_counts, s.pair_counts
            rows = np.stack([ph[at], at, pt[at], v, wt[v], wh[v], w, wt[w], wh[w]])
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([_pack(rows.ravel())], pa.binary())],
                                             names=["slice", "arrays"])


def _bucket(context: np.ndarray) -> np.ndarray:
    """Frequency bucket of a context: 0 for 0, then the bits of its count."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], CONTEXTS - 1)


def _tuned(key, part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """Held-out bigrams with the counts that remain when the tune documents are deleted."""
    if not len(part):
        return pd.DataFrame({c.split()[0]: np.zeros(0, np.int64) for c in TUNED.split(", ")})
    f = dict(zip(_TUNE_FIELDS, _unpack(part["arrays"].iloc[0], np.int64).reshape(len(_TUNE_FIELDS), -1)))
    (wt, wh), (pt, ph) = (_totals(answers, kind, (0, 0)) for kind in (WORD, PAIR))
    pair = f["pair_train"] + pt[f["pair"]] - f["n"] - ph[f["pair"]]
    before, word = (f[f"{c}_train"] + wt[f[c]] - f[f"{c}_tune"] - wh[f[c]] for c in "vw")
    return pd.DataFrame({"context": _bucket(before), "pair": pair, "before": before, "word": word, "n": f["n"]})


def fit_weights(held_out: DataFrame, total: int, different: int) -> np.ndarray:
    """EM over the held-out bigrams: a row (l2, l1, l0) for each context bucket.

    One vote for the uniform part in each bucket keeps every probability above
    zero. A bucket without held-out bigrams takes the weights of all buckets together.
    """
    weights = np.full((CONTEXTS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5                                        # an unseen context says nothing
    p2 = F.when(F.col("before") > 0, F.col("pair") / F.col("before")).otherwise(0.0)
    p1 = F.col("word") / F.lit(float(max(total, 1)))
    p0 = F.lit(1.0 / (different + 1))
    for _ in range(ROUNDS):
        l2, l1, l0 = (F.element_at(F.lit([float(x) for x in weights[:, k]]), F.col("context") + 1) for k in range(3))
        a, b, c = l2 * p2, l1 * p1, l0 * p0
        got = held_out.groupBy("context").agg(*[F.sum(F.col("n") * x / (a + b + c)) for x in (a, b, c)]).collect()
        votes = np.zeros((CONTEXTS, 3))
        for r in got:
            votes[r[0]] = r[1:]
        seen = votes.sum(axis=1) > 0
        votes[:, 2] += 1
        new = votes / votes.sum(axis=1, keepdims=True)
        new[~seen] = votes.sum(axis=0) / votes.sum()
        if not seen[0]:
            new[0] = 0, *(new[0, 1:] / new[0, 1:].sum())
        change, weights = np.abs(new - weights).max(), new
        if change < CLOSE:
            break
    return weights


# ---------------------------------------------------------------------- scores
SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scorer(weights: np.ndarray, total: int, different: int):
    def run(part: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return pd.DataFrame({n: np.zeros(0, {"long": np.int64, "boolean": bool, "double": float}[t])
                                 for n, t in map(str.split, SCORED.split(", "))})
        s = _Slice(*(part[c].iloc[0] for c in ("words", "codes", "pieces")))
        word, _ = _totals(answers, WORD, s.word_counts)
        pair, _ = _totals(answers, PAIR, s.pair_counts)
        before = word[np.where(s.pair_v == s.start, s.end, s.pair_v)]
        l2, l1, l0 = weights[_bucket(before)].T
        p = l2 * pair / np.maximum(before, 1) + l1 * word[s.pair_w] / max(total, 1) + l0 / (different + 1)
        base = np.log10((word + 1) / (total + different + 1))
        n = len(s.pieces)
        sums = [np.bincount(s.piece, weights=x, minlength=n)
                for x in (base[s.w], np.log10(p)[s.pair])]
        known = np.bincount(s.piece[word[s.w] > 0], minlength=n)
        ids = pd.array(s.pieces["doc_id"].astype(np.int64), "Int64")
        ids[s.pieces["null_id"] > 0] = pd.NA
        return pd.DataFrame({"row": s.pieces["row"], "doc_id": ids, "held_out": s.pieces["held"] > 0, "n_tokens": s.pieces["len"] - 1,
                             "n_known": known, "base_score": sums[0], "score": sums[1]})
    return run


def score(spark: SparkSession, docs: DataFrame, held_out: Column, train: Column, tune: Column,
          slice_tokens: int = SLICE_TOKENS, read_bytes: int = READ_BYTES, range_entries: int = RANGE_ENTRIES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``train`` picks the documents to learn from, ``tune`` the part of them whose
    counts are held out to learn the weights; ``held_out`` is only reported.
    """
    scratch = Scratch(spark, "interpolation")
    flags = [F.coalesce(c, F.lit(False)).alias(n) for c, n in ((held_out, "held"), (train, "train"), (train & tune, "tune"))]
    read = docs.select(F.spark_partition_id().alias("part"), F.col("doc_id").cast("long").alias("doc_id"), *flags, "text")
    slices = scratch.put(read.mapInArrow(trimmed(_slicer(slice_tokens, read_bytes)), SLICES), "slices")
    n_words, n_tokens = slices.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    bits = {k: max(0, math.ceil(math.log2(max(1, (n or 0)) / range_entries))) if n else 0 for k, n in ((WORD, n_words), (PAIR, n_tokens))}

    # every range in one task of its own: deal them evenly
    asked = slices.select("slice", "words", "codes", "pieces").mapInArrow(trimmed(_ask(bits)), ASKED)
    answers = scratch.put(asked.groupBy("kind", "hash_range").applyInPandas(_answer, ANSWER), "answers")
    total, tune_total, different = (x or 0 for x in answers.where(F.col("kind") == WORD).agg(
        F.sum("total"), F.sum("tune_total"), F.sum("different")).first())

    replies = answers.select("slice", "kind", "hash_range", "train", "tune")
    part = slices.select("slice", "words", "codes", "pieces").mapInArrow(trimmed(_tune_part), TUNE_PART)
    tuned = scratch.put(part.groupBy("slice").cogroup(replies.groupBy("slice")).applyInPandas(_tuned, TUNED), "tuned")
    weights = fit_weights(tuned, total - tune_total, different)

    scored = (slices.select("slice", "words", "codes", "pieces").groupBy("slice").cogroup(replies.groupBy("slice"))
              .applyInPandas(_scorer(weights, total, different), SCORED))
    return (scored.groupBy("row", "doc_id", "held_out")
            .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
            .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))
