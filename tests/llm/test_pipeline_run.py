"""run() on a small copy of documents in several files, against plain Python.

The quality stage's decisions are taken from the operator (its models are fitted from the rows); its
effect and the four stages after it are computed anew, row by row.
"""

import collections
import hashlib
import itertools
import math
import re

import sentencepiece

import corpus_pipeline
from tagstream.llm import importance_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, width):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    n = min(width, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


def exact(rows):
    best = {}
    for r in rows:
        key = re.sub("[\x20\x09-\x0d]", "", r["text"] or "")
        rank = (-len(r["text"] or ""), r["doc_id"])
        if key not in best or rank < best[key][0]:
            best[key] = rank, r
    return [r for _, r in best.values()]


def near(rows, width=5, num=80, den=100):
    sets = {r["doc_id"]: shingles(r["text"], width) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [r for r in rows if find(r["doc_id"]) == r["doc_id"]]


def mix(rows, seed):
    """Each row as often as its hash's Poisson quantile says; every source has the same expected share."""
    n = collections.Counter(r["source"] for r in rows)
    out = []
    for r in rows:
        mean = len(rows) / len(n) / n[r["source"]]
        parts = max(1, math.ceil(mean / 16))
        for j in range(1, parts + 1):
            digest = hashlib.md5(f"{seed}|{r['doc_id']}|{j}".encode()).hexdigest()
            u = (int(digest[:13], 16) + 0.5) / (1 << 52)
            k, p = 0, math.exp(-mean / parts)
            c = p
            while c < u:
                k += 1
                p *= mean / parts / k
                c += p
            out += [r] * k
    return out


def test_run_equals_plain_python(spark, tmp):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.repartition(4).write.parquet(f"{tmp}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.write.parquet(f"{tmp}/labels.parquet")
    got = corpus_pipeline.run(spark, tmp)
    assert got.columns == ["doc_id", "n_ids", "ids"]

    kept = {r.doc_id for r in importance_resampling.classify(spark, spark.read.parquet(f"{tmp}/documents.parquet"), labels)
            .where("kept").collect()}
    rows = [r.asDict() for r in docs.collect() if r.doc_id in kept]
    assert 0 < len(rows) < docs.count()
    unique = exact(rows)
    single = near(unique)
    assert len(single) < len(unique) <= len(rows)
    lib = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.TOKENIZER)
    want = collections.Counter((r["doc_id"], tuple(lib.encode(r["text"] or ""))) for r in mix(single, corpus_pipeline.MIX_SEED))
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got.collect()) == want
