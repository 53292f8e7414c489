"""Secret scan: fixed patterns, and Markov models of random strings against identifiers.

Base spans come from three patterns. The method adds spans: every longer run of
token characters, without what base spans cover of it, is scored by two first-order
character Markov models, one of random strings (values of base matches) and
one of ordinary identifiers (other tokens), both trained from the documents,
where the base patterns give the labels. A run whose log-likelihood ratio
passes the threshold is reported as kind ``markov``.

Defined cases: a null text counts as empty and has no spans; offsets are code
points, end exclusive; overlapping spans of different kinds all stay; without
any random string in the training sample the first model is uniform; repeated
rows each get a row; only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
TRAIN_DOCS = 20_000      # expected documents of the labelled training sample
MIN_RUN = 16             # characters of a candidate run
MIN_LLR = 12.0           # nats: the prior odds against a run being random
BACKOFF = 5.0            # pseudo-counts of the fallback model

# fixed values: the base patterns
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("passw", "secret", "token", "api")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
IDENT = re.compile(r"[A-Za-z0-9+/_=-]{4,}")


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base patterns, leftmost non-overlapping per kind."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return out


def _steps(value: str) -> Iterator[tuple[str, str]]:
    return zip(value, value[1:])


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for b in batches:
        for t in b.column(0):
            text = t.as_py() or ""
            base = base_spans(text)
            for value in {v for *_, v in base}:
                counts.update((True, a, c) for a, c in _steps(value))
            plain, at = [], 0
            for s, e, *_ in sorted(base):
                plain.append(text[at:max(at, s)])
                at = max(at, e)
            plain.append(text[at:])
            for part in plain:
                for m in IDENT.finditer(part):
                    counts.update((False, a, c) for a, c in _steps(m[0]))
    keys = list(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([k[2] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())],
        names=["random", "a", "c", "n"])


def train(docs: DataFrame, bound: int = TRAIN_DOCS) -> dict[str, float]:
    """Log-likelihood ratio per character pair (random string against identifier).

    Pairs are counted over a sample of about ``bound`` documents drawn by a
    hash of the id; at most twice the squared alphabet reaches the driver.
    """
    share = min(1.0, bound / max(docs.count(), 1))
    rank = (F.xxhash64("doc_id", F.lit(53)).cast("double") / 9223372036854775807 + 1.0) / 2.0
    rows = (docs.where(rank <= share).select("text").mapInArrow(_count_batches, "random boolean, a string, c string, n long")
            .groupBy("random", "a", "c").agg(F.sum("n").alias("n")).collect())
    n = {(r["random"], r["a"] + r["c"]): r["n"] for r in rows}
    size = len(ALPHABET)
    # unseen pairs fall back on the model's own character frequencies, those on a uniform one (random strings: at once)
    after = {c: sum(n.get((False, a + c), 0) for a in ALPHABET) for c in ALPHABET}
    seen = sum(after.values())
    back = {True: dict.fromkeys(ALPHABET, 1 / size), False: {c: (after[c] + 0.5) / (seen + 0.5 * size) for c in ALPHABET}}
    out = {}
    for a in ALPHABET:
        total = {k: sum(n.get((k, a + c), 0) for c in ALPHABET) for k in (True, False)}
        for c in ALPHABET:
            p, q = ((n.get((k, a + c), 0) + BACKOFF * back[k][c]) / (total[k] + BACKOFF) for k in (True, False))
            out[a + c] = math.log(p) - math.log(q)
    return out


def llr(value: str, ratio: dict[str, float]) -> float:
    return sum(ratio.get(a + c, 0.0) for a, c in _steps(value))


def spans(text: str, ratio: dict[str, float]) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind) by start, then kind as listed."""
    base = sorted(base_spans(text))
    out = [(s, e, k) for s, e, k, _ in base]
    for m in RUN.finditer(text):
        at = m.start()
        for s, e in [*((s, e) for s, e, *_ in base if s < m.end() and m.start() < e), (m.end(), m.end())]:
            if s - at >= MIN_RUN and llr(text[at:s], ratio) >= MIN_LLR:
                out.append((at, s, "markov"))
            at = max(at, e)
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


def scan(docs: DataFrame, ratio: dict[str, float]) -> DataFrame:
    """(doc_id, spans) with spans as an array of (start, stop, kind)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("kind", pa.string())]))
        for b in batches:
            found = [[{"start": s, "stop": e, "kind": k} for s, e, k in spans(t.as_py() or "", ratio)] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, spans array<struct<start:long,stop:long,kind:string>>")


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov from ``scan``'s rows."""
    def text(found):
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["kind"] != "markov")
    return scanned.select("doc_id", count("assign"), count("access"), count("hex"),
                          F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"),
                          count("markov"))
