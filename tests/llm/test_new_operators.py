"""Hard negatives, interpolated scores and the divergence audit against plain Python, with the defined odd cases."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagstream.llm import bwt_dedup, epsilon_grid, exact_dedup
from tagstream.llm import deleted_interpolation as di
from tagstream.llm import lemp_negatives as ln
from tagstream.llm import quadtree_audit as qa

DOCS = "doc_id long, text string, lang string, source string, n_chars long, part string, n string, vec_id string, row string"
EXTRA = (None, "clash", "clash", "clash", "clash")
R = random.Random(11)
WORDS = ["".join(R.choice("abcdefghij") for _ in range(R.randint(1, 5))) for _ in range(120)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS[:10] if r.random() < 0.5 else WORDS) for _ in range(n))


LONG = prose(3000, 0)
TEXTS = [prose(40, 1), None, "", " \t\r\n", "One ONE one", "É é ÄÖ ß日本語 x1y2", "a-b_c'd", LONG, LONG + " End", "z" * 3000,
         prose(40, 1), *[prose(30 + 7 * i, 20 + i) for i in range(40)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None, "en"][i % 4], [f"s{i % 9}", None, "", "ü", "a"][i % 5], *EXTRA) for i, t in enumerate(TEXTS)]
    rows += [rows[0], (None, "null id one", "en", "a", *EXTRA), (None, None, None, None, *EXTRA), (900, None, "xx", "only", *EXTRA),
             (901, "lonely words here", "yy", "p", *EXTRA), (902, None, "yy", "q", *EXTRA)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


# ------------------------------------------------------------------------ op13
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def audit_brute(rows, min_docs=3, top=200):
    count, seen, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        groups[lang].add(source)
        terms = TERM.findall(lower(r["text"] or ""))
        count[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        v = len(kept)

        def shares(c, kept=kept, v=v):
            n = sum(c[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // (n + v) for t in kept}
        total = sum((count[lang, s] for s in sources), collections.Counter())
        q = shares(total)
        p = {s: shares(count[lang, s]) for s in sources}
        for s in sources:
            pair = sorted(((-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode()) for o in sources if o != s))
            out |= {(lang, s, "pair", o.decode(), -x, i) for i, (x, o) in enumerate(pair, 1)}
            term = sorted((-((p[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])
            out |= {(lang, s, "term", t.decode(), -x, i) for i, (x, t) in enumerate(term[:top], 1)}
    return out


@pytest.mark.parametrize("sizes", [{}, {"stripe": 5, "block": 2, "read_bytes": 200}])
def test_audit_equals_brute_force(spark, docs, sizes):
    got = qa.audit(spark, docs, **sizes).collect()
    rows = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got}
    assert len(rows) == len(got) and rows == audit_brute(docs.collect())


def test_audit_odd_tables(spark, docs, no_docs):
    assert qa.audit(spark, no_docs).count() == 0
    # no kept term: pairs of value 0 in the order of their names
    yy = [tuple(r) for r in qa.audit(spark, docs.where("lang = 'yy'")).orderBy("source").collect()]
    assert yy == [("yy", "p", "pair", "q", 0, 1), ("yy", "q", "pair", "p", 0, 1)]


def test_quadrants_price_every_cell_once():
    rng = np.random.default_rng(0)
    for na, nb, nc, share in ((3, 5, 17, 0.1), (8, 8, 64, 0.02), (1, 1, 1, 0.0), (7, 2, 9, 1.0), (4, 4, 0, 0.5)):
        ha, hb = rng.random((na, nc)) < share, rng.random((nb, nc)) < share
        za, zb = rng.integers(1, 50, na), rng.integers(1, 50, nb)
        p = np.where(ha, rng.integers(50, 99, (na, nc)), za[:, None])
        q = np.where(hb, rng.integers(50, 99, (nb, nc)), zb[:, None])
        ab, ba = qa.block_pair(p, ha, za, q, hb, zb)
        assert np.array_equal(ab, ((p[:, None] - q[None]) ** 2 // q[None]).sum(axis=2))
        assert np.array_equal(ba, ((p[:, None] - q[None]) ** 2 // p[:, None]).sum(axis=2))


def test_empty_quadrants_are_not_opened():
    tree = qa.levels(np.zeros((16, 64), bool))
    empty, (a, _, _) = qa.joint(tree, tree, (16, 16, 64))
    assert len(a) == 0 and (empty == 64).all()


# ------------------------------------------------------------------------ op12
WORD = re.compile("[^\x20\x09-\x0d]+")


def interpolation_brute(rows, train, tune, rounds=di.ROUNDS, close=di.CLOSE):
    """(n_tokens, n_known, base, score) of each row, in order, and N."""
    def tokens(t):
        return [*WORD.findall(lower(t or "")), None]
    streams = [tokens(r["text"]) for r in rows]
    one, two, held_one, held_two = (collections.Counter() for _ in range(4))
    for r, s in zip(rows, streams):
        pairs = list(zip(["", *s[:-1]], s))                  # "" is the start mark
        if train(r):
            one.update(s)
            two.update(pairs)
            if tune(r):
                held_one.update(s)
                held_two.update(pairs)
    n, v = sum(one.values()), len(one)

    def context(counts, w):
        return counts[None if w == "" else w]

    def bucket(c):
        return min(c.bit_length(), di.CONTEXTS - 1)
    left = n - sum(held_one.values())
    events = []
    for (a, b), k in held_two.items():
        c = context(one, a) - context(held_one, a)
        pair = two[a, b] - held_two[a, b]
        events.append((bucket(c), k, pair / c if c else 0.0, (one[b] - held_one[b]) / max(left, 1), 1 / (v + 1)))
    w = np.full((di.CONTEXTS, 3), 1 / 3)
    w[0] = 0, 0.5, 0.5
    for _ in range(rounds):
        votes = np.zeros((di.CONTEXTS, 3))
        for b, k, *p in events:
            x = w[b] * p
            votes[b] += k * x / x.sum()
        seen = votes.sum(axis=1) > 0
        votes[:, 2] += 1
        new = votes / votes.sum(axis=1, keepdims=True)
        new[~seen] = votes.sum(axis=0) / votes.sum()
        if not seen[0]:
            new[0] = [0, *(new[0, 1:] / new[0, 1:].sum())]
        change, w = np.abs(new - w).max(), new
        if change < close:
            break
    out = []
    for s in streams:
        base = sum(math.log10((one[t] + 1) / (n + v + 1)) for t in s)
        score = 0.0
        for a, b in zip(["", *s[:-1]], s):
            c = context(one, a)
            l2, l1, l0 = w[bucket(c)]
            score += math.log10(l2 * (two[a, b] / c if c else 0.0) + l1 * one[b] / max(n, 1) + l0 / (v + 1))
        out.append((len(s), sum(one[t] > 0 for t in s), base, score))
    return out, n


def crc(r):
    return None if r["doc_id"] is None else zlib.crc32(str(r["doc_id"]).encode())


def scored(spark, docs, **sizes):
    c = F.crc32(F.col("doc_id").cast("string"))
    return di.score(spark, docs, held_out=c % 7 == 2, train=c % 7 != 2, tune=F.floor(c / 7) % 4 == 0, **sizes).collect()


@pytest.mark.parametrize("sizes", [{}, {"slice_tokens": 300, "read_bytes": 400, "range_entries": 64}])
def test_scores_equal_brute_force(spark, docs, sizes):
    rows = docs.collect()
    want, n = interpolation_brute(rows, lambda r: crc(r) is not None and crc(r) % 7 != 2, lambda r: crc(r) // 7 % 4 == 0)
    got = scored(spark, docs, **sizes)
    assert {r.train_tokens for r in got} == {n}

    def key(i, t, k, b, s):
        return (i is None, i or 0, t, k, round(b, 6), round(s, 6))
    assert sorted(key(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got) == sorted(
        key(r["doc_id"], *w) for r, w in zip(rows, want))
    assert {r.doc_id for r in got if r.held_out} == {r["doc_id"] for r in rows if crc(r) is not None and crc(r) % 7 == 2}


def test_scores_without_training(spark, docs, no_docs):
    assert scored(spark, no_docs) == []
    got = di.score(spark, docs.where("doc_id < 3"), F.lit(True), F.lit(False), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and abs(r.score) < 1e-9 and abs(r.base_score) < 1e-9 for r in got)


def test_held_out_text_is_better_explained_than_by_words_alone(spark):
    rows = [(i, prose(200, 1000 + i % 60) + " " + " ".join(WORDS[20:40]), "en", "s", *EXTRA) for i in range(150)]
    got = [r for r in scored(spark, spark.createDataFrame(rows, DOCS)) if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got)


# ------------------------------------------------------------------------ op11
VECS = "vec_id long, embedding array<float>, label int, row string, q string, g string"


def negatives_brute(rows, scale=256, k=5, low=80, high=100):
    take = []
    for r in rows:
        e = r[1]
        if r[0] is None or r[2] is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        q = [math.floor(scale * float(np.float32(x))) for x in e]
        if sum(x * x for x in q) >= 1 << 53:
            continue
        take.append((r[0], r[2], q))
    dim = max((len(q) for *_, q in take), default=0)
    m = np.array([q + [0] * (dim - len(q)) for *_, q in take], dtype=object)
    out = collections.Counter()
    for a, (i, label, _) in enumerate(take):
        if i % 100:
            continue
        s = m @ m[a] if dim else [0] * len(take)
        order = sorted((b for b in range(len(take)) if b != a), key=lambda b: (-s[b], take[b][0]))
        for p in [b for b in order if take[b][1] == label][:k]:
            neg = [b for b in order if take[b][1] != label and low * s[p] <= 100 * s[b] <= high * s[p]][:k]
            for rank, b in enumerate(neg, 1):
                out[i, take[p][0], rank, take[b][0], s[p], s[b]] += 1
    return out


def vectors(n, seed=0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, 8))
    rows = []
    for i in range(n):
        v = centre[i % 6] * rng.choice([0.5, 1.0, 3.0]) + rng.normal(scale=0.4, size=8)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4)), "x", "x", "x"))
    return rows


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, VECS).repartition(3)
    return collections.Counter(tuple(r) for r in ln.mine(spark, df, F.col("vec_id") % 100 == 0, **more).collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    rows = vectors(1500)
    rows += [(100_000 + i, rows[i][1], rows[i][2], "x", "x", "x") for i in range(40)]             # ties: equal vectors
    rows += [(None, rows[0][1], 1, "x", "x", "x"), (2000, None, 1, "x", "x", "x"), (2100, [1.0, None], 1, "x", "x", "x"),
             (2200, [math.nan] * 8, 1, "x", "x", "x"), (2300, [math.inf] * 8, 1, "x", "x", "x"), (2400, rows[1][1], None, "x", "x", "x"),
             (2500, [0.0] * 8, 1, "x", "x", "x"), (2600, [], 1, "x", "x", "x"), (2700, [2.0, 1.0], 2, "x", "x", "x"),
             (2800, [1e30] * 8, 2, "x", "x", "x"), (2900, [-1.5] * 8, 77, "x", "x", "x")]
    want = negatives_brute(rows)
    assert sum(want.values()) > 200 and mined(spark, rows) == want
    monkeypatch.setattr(ln, "GROUP_ROWS", (40, 100))                                # many groups and anchor chunks
    monkeypatch.setattr(ln, "ANCHOR_CHUNK", 3)
    assert mined(spark, rows) == want


def test_negatives_odd_tables(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(0, [1.0, 2.0], 1, "x", "x", "x")])                    # no positive
    assert not mined(spark, [(i, [1.0, 2.0], 1, "x", "x", "x") for i in range(9)])  # no negative
    rows = [(0, [1.0], 1, "x", "x", "x")] * 2 + [(5, [1.0], 2, "x", "x", "x")]      # a repeated anchor: rows of their own
    assert mined(spark, rows) == {(0, 0, 1, 5, 65536, 65536): 2}


def test_pruning_keeps_every_row_above_the_threshold():
    rng = np.random.default_rng(3)
    q = np.round(rng.normal(size=(300, 16)) * 100).astype(np.int32)
    unit = ln._unit(q.astype(float))
    lists = np.argsort(unit.T, axis=1, kind="stable").astype(np.uint16)
    row = collections.namedtuple("B", "n max_len2 rows ids labels q lists")(
        300, int((q.astype(int) ** 2).sum(axis=1).max()), *[np.arange(300).tobytes()] * 3, q.tobytes(), lists.tobytes())
    b = ln._Block(row, 16)
    read = 0
    for a in range(50):
        cosine = unit @ unit[a]
        for t in (0.2, 0.5, 0.8, 0.99):
            found = b.candidates(unit[a], np.argsort(-np.abs(unit[a]))[:ln.FOCUS], t)
            assert set(np.flatnonzero(cosine >= t)) <= set(np.asarray(found).tolist())
            read += len(found)
    assert read < 50 * 4 * 300 * 0.7


# --------------------------------------------------- null and repeated ids of earlier operators
def test_keep_unique_decides_rows_not_ids(spark):
    rows = [(1, "A text"), (0, "A text"), (1, "B only here"), (None, "C"), (None, "C "), (5, "C"), (None, "D alone"),
            (None, "D alone"), (7, None), (8, " "), (9, "E"), (9, "E"), (9, "E"), (10, "F")]
    df = spark.createDataFrame([(i, t, "en", "s", *EXTRA) for i, t in rows], DOCS).repartition(3)
    got = collections.Counter((r.doc_id, r.text) for r in exact_dedup.keep_unique(spark, df).collect())
    # the longest text of a group, then the smallest id; null ids last
    assert got == collections.Counter([(0, "A text"), (1, "B only here"), (None, "C "), (None, "D alone"), (8, " "), (9, "E"), (10, "F")])


def test_exact_dedup_null_ids_come_last(spark):
    df = spark.createDataFrame([(None, "x", "en", "s", *EXTRA), (4, "x", "en", "s", *EXTRA)] * 2, DOCS)
    got = exact_dedup.exact_dedup(spark, *exact_dedup.split_batches(df)).collect()
    assert [r.keep_id for r in got] == [4] * 4 and {r.group_size for r in got} == {4}


def test_vectors_without_id_never_name_a_component(spark):
    rows = [(7, [1.0, 0.0], 1), (None, [1.0, 0.001], 1), (3, [0.0, 1.0], 1), (None, [-1.0, 0.0], 1), (None, [-1.0, 0.0], 1), (9, None, 1)]
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECS)
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in epsilon_grid.near_duplicates(spark, df).collect()), key=repr)
    assert got == sorted([(7, 1, 7, True), (None, 1, 7, False), (3, 0, 3, True), (None, 1, None, True), (None, 1, None, False),
                          (9, 0, 9, True)], key=repr)


def test_bwt_null_id_counts_as_earliest(spark):
    text = "".join(random.Random(4).choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(240))
    df = spark.createDataFrame([(None, text), (1, text), (2, text)], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in bwt_dedup.digest(bwt_dedup.remove_repeats(spark, df)).collect()}
    assert got == {None: 0, 1: 240, 2: 240}


def test_word_hashes_work_in_small_blocks():
    """The memory that hashing takes beside its result does not grow with the text, and is a few MB."""
    import tracemalloc

    import numpy as np

    from tagstream.llm.common import word_hashes
    text = np.frombuffer(b"some-words-here " * (1 << 18), np.uint8)
    word_hashes(text)                                   # the table of powers is made once
    tracemalloc.start()
    out = word_hashes(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 1 << 18 and len(set(out.tolist())) == 1
    assert peak - 2 * out.nbytes < 8 << 20
