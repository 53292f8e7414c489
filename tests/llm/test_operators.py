"""Every numbered operator on small tables: brute force, round trips, and the defined odd cases."""

import hashlib
import math
import random
import re

import numpy as np
import pytest

from tagstream.llm import (bwt_dedup, epsilon_grid, exact_dedup, feistel_pii, importance_resampling, markov_secrets,
                           partenum_join, poisson_mix, spm_viterbi, zstd_lang)

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, copy string"

RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(300)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, places, seed):
    w = text.split(" ")
    r = random.Random(seed)
    for _ in range(places):
        w[r.randrange(len(w))] = r.choice(WORDS)
    return " ".join(w)


LONG = prose(30_000, 1)
TEXTS = [prose(120, 2), None, "", " \t\n", "one", "One  TWO", prose(120, 2), prose(120, 2) + " ", edited(prose(120, 2), 2, 3),
         edited(prose(120, 2), 30, 4), LONG, LONG + " end", prose(400, 5), edited(prose(400, 5), 4, 6), "日本語 é 😀", "a" * 3000,
         "der " * 400, prose(60, 8) + " " + prose(60, 5)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], ["x", "y", None, "x"][i % 4], None, "clash", "clash") for i, t in enumerate(TEXTS)]
    rows.append(rows[0])                                     # a repeated row
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# ------------------------------------------------------------------------- op1
def test_viterbi_equals_library_and_restores(docs, empty):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = rows_of(spm_viterbi.encode(docs, MODEL, verify=True))
    for i, t in enumerate(TEXTS):
        assert got[i]["ids"] == lib.encode(t or "") and got[i]["restored"] and got[i]["n_ids"] == len(got[i]["ids"])
    back = rows_of(spm_viterbi.decode(spm_viterbi.encode(docs, MODEL), MODEL))
    assert all(back[i]["text"] == (t or "") for i, t in enumerate(TEXTS))
    assert spm_viterbi.encode(empty, MODEL).count() == 0


def test_stream_commits_early_with_bounded_window():
    codec = spm_viterbi.codec(spm_viterbi.read_model(MODEL))
    text = spm_viterbi.SPACE + ("abc" * 4000 + " " + LONG[:4000]).replace(" ", spm_viterbi.SPACE)
    stream, out, widest = spm_viterbi.StreamingViterbi(codec.model), [], 0
    for k in range(0, len(text), 11):
        out += stream.feed(text[k:k + 11])
        widest = max(widest, stream.window)
    assert widest <= 4 * codec.model.longest
    out += stream.finish()
    assert out == np.frombuffer(codec.encode("abc" * 4000 + " " + LONG[:4000]), np.int32).tolist()


def test_unigram_path_is_the_best_one():
    from sentencepiece import sentencepiece_model_pb2
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(spm_viterbi.read_model(MODEL))
    proto.trainer_spec.model_type = 1
    model = spm_viterbi.PieceModel(proto.SerializeToString())
    for word in ("▁thereby", "▁unhappiness", "▁zzzz", "xyzzy"):
        best = [0.0] + [-math.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in model.pieces:
                    best[e] = max(best[e], best[s] + model.score[model.pieces[word[s:e]]])
        ids = spm_viterbi.StreamingViterbi(model).segment(word)
        assert sum(model.score[i] for i in ids) == pytest.approx(best[-1])


# ------------------------------------------------------------------------- op2
def test_importance_resampling(spark, empty):
    good = [(i, prose(80, 100 + i)) for i in range(60)]
    junk = [(100 + i, " | ".join(prose(60, 300 + i).split(" "))) for i in range(15)] + [(200 + i, f"{w} " * 90) for i, w in enumerate(WORDS[:5])]
    extra = [(300, None), (301, ""), (0, good[0][1])]
    table = spark.createDataFrame(good + junk + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100 + i, 0, 0) for i in range(8)] + [(200, 0, 0), (0, 1, 0), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = importance_resampling.classify(spark, table, labels).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert len(got) == len(good + junk + extra)
    assert {i for i, _ in good} <= kept and not kept & {i for i, _ in junk}
    stay = importance_resampling.keep_sampled(spark, table, labels)
    assert stay.columns == table.columns and {r["doc_id"] for r in stay.collect()} == kept
    assert importance_resampling.classify(spark, empty, labels).count() == 0
    assert importance_resampling.classify(spark, table, labels.limit(0)).where("NOT kept").count() == 0


def test_kth_largest(spark):
    values = [random.Random(1).gauss(0, 1) for _ in range(9000)] + [5.0, 5.0, 5.0]
    keys = spark.createDataFrame([(v,) for v in values], "key double")
    for k in (1, 3, 4, 4500, len(values) - 1):
        assert importance_resampling.kth_largest(keys, k) == sorted(values, reverse=True)[k - 1]


# ------------------------------------------------------------------------- op3
def test_feistel_pseudonyms(spark, docs, empty):
    text = ("mail a.b3@mail7.example.com card 4111111111111111 and 4111-1111-1111-1111 not 4111111111111112 ip 97.51.17.173 "
            "not 999.1.1.1 ssn 123-45-6789 not 000-12-3456 on 1985-02-28 or 28.02.1985 not 1985-02-30 "
            "iban DE89370400440532013000 phone +1 (702) 555-0742")
    table = spark.createDataFrame([(1, text, "c"), (2, text, "c"), (3, None, "c"), (4, "", "c"), (5, "clean text 12", "c")],
                                  "doc_id int, text string, pii string")
    got = rows_of(feistel_pii.pseudonymise(table, "key"))
    assert got[1]["text"] == got[2]["text"] != text
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "clean text 12"
    found = {(p["kind"], p["value"]): p["pseudonym"] for p in got[1]["pii"]}
    assert {k for k, _ in found} == set(feistel_pii.KINDS)
    for (kind, value), new in found.items():
        assert new != value and value not in got[1]["text"]
        assert re.sub("[a-z]", "a", re.sub("[0-9]", "0", new)) == re.sub("[a-z]", "a", re.sub("[0-9]", "0", value)) or kind == "ipv4"
    for keep in ("4111111111111112", "999.1.1.1", "000-12-3456", "1985-02-30"):
        assert keep in got[1]["text"]
    card = found["card", "4111111111111111"]
    assert sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(card)) % 10 == 0
    assert found["card", "4111-1111-1111-1111"].replace("-", "") == card
    iban = found["iban", "DE89370400440532013000"]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert feistel_pii.pseudonymise(empty, "key").count() == 0
    assert rows_of(feistel_pii.pseudonymise(docs, "key"))[0]["kept"] == "clash"


def test_number_network_is_a_permutation(spark):
    x = spark.range(75 * 487).selectExpr(f"{feistel_pii.permute_number('id', '75', '487', 'k', 't')} AS y")
    assert x.distinct().count() == 75 * 487 and x.selectExpr("min(y)", "max(y)").first()[:] == (0, 75 * 487 - 1)


# ------------------------------------------------------------------------- op4
def test_poisson_mix(spark, empty):
    rows = [(i, "t" * (i % 5), "big" if i < 4000 else ["a", "b", None][i % 3], "x") for i in range(4600)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string")
    got = poisson_mix.replicate(spark, table)
    n = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert set(n) == {"big", "a", "b", None} and all(abs(v - 1150) < 200 for v in n.values())
    assert got.groupBy("doc_id").agg({"copy": "max", "doc_id": "count"}).where("`max(copy)` <> `count(doc_id)`").count() == 0
    plain = poisson_mix.replicate(spark, table, {"a": 1.0}, epochs=0.5, copy_col=None)
    assert plain.columns == table.columns and {r["source"] for r in plain.collect()} == {"a"}
    assert poisson_mix.replicate(spark, empty).count() == 0
    few = spark.createDataFrame([(1, "s"), (2, "s")], "doc_id long, source string")
    assert abs(poisson_mix.replicate(spark, few, epochs=3000.0).count() - 6000) < 400      # large means, many parts


# ------------------------------------------------------------------------- op5
def brute_repeats(texts):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        cut = bytearray(len(raw))
        for p in range(len(raw) - 99):
            w = raw[p:p + 100]
            if w in seen:
                cut[p:p + 100] = b"\x01" * 100
            seen.add(w)
        kept = bytes(c for c, x in zip(raw, cut) if not x)
        out[i] = (len(raw), sum(cut), len(re.findall(rb"\x01+", bytes(cut))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("shard", [1 << 15, 600])
def test_bwt_dedup_equals_brute_force(spark, docs, empty, shard, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "SHARD", shard)
    got = rows_of(bwt_dedup.digest(bwt_dedup.remove_repeats(spark, docs)))
    for i, want in brute_repeats(TEXTS).items():
        assert tuple(got[i][1:]) == want, i
    assert bwt_dedup.remove_repeats(spark, empty).count() == 0


def test_bwt_hot_minimizer_is_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "HOT", 8, raising=False)
    passage = prose(40, 70)
    texts = [prose(20, 100 + i) + " " + passage + " " + prose(20, 200 + i) for i in range(40)] + [passage, passage]
    table = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 4), "doc_id long, text string")
    got = rows_of(bwt_dedup.digest(bwt_dedup.remove_repeats(spark, table)))
    for i, want in brute_repeats(texts).items():
        assert tuple(got[i][1:]) == want, i
    per_key = {}
    for r in bwt_dedup.segments(table).where("key IS NOT NULL").collect():
        per_key.setdefault(r["key"], set()).add(bytes(r["seg"]))
    assert max(map(len, per_key.values())) <= 8


def test_interleave_merge_classes():
    r = random.Random(3)
    base = [bytes(r.choice(b"ab") for _ in range(150)) for _ in range(3)]
    segs = [bytes(b if r.random() > 0.005 else 99 for b in r.choice(base))[r.randrange(30):] for _ in range(40)]
    for shard in (1 << 15, 500):
        old, bwt_dedup.SHARD = bwt_dedup.SHARD, shard
        classes, off, seen = bwt_dedup.window_classes(segs), 0, {}
        bwt_dedup.SHARD = old
        for s in segs:
            for p in range(len(s) - 99):
                assert seen.setdefault(s[p:p + 100], classes[off + p]) == classes[off + p]
            off += len(s) + 1
        assert len(set(seen.values())) == len(seen)


# ------------------------------------------------------------------------- op6
def test_exact_dedup(spark, docs, empty):
    got = exact_dedup.exact_dedup(spark, *exact_dedup.split_batches(docs)).collect()
    assert len(got) == len(TEXTS) + 1
    bare = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in TEXTS]
    for r in got:
        same = [i for i, b in enumerate(bare) if b == bare[r["doc_id"]]]
        keep = min(same, key=lambda i: (-len(TEXTS[i] or ""), i))
        assert r["keep_id"] == keep and r["kept"] == (r["doc_id"] == keep)
        assert r["group_size"] == len(same) + (0 in same)                  # doc 0 stands in the table twice
        assert r["text_sha256"] == hashlib.sha256(bare[r["doc_id"]].encode()).hexdigest()
    assert exact_dedup.exact_dedup(spark, empty, empty).count() == 0
    assert exact_dedup.keep_unique(spark, docs).columns == docs.columns


def test_fuse_filter_has_no_false_negatives():
    for n in (0, 1, 2, 10, 5000):
        keys = np.random.default_rng(n).integers(0, 1 << 63, n).astype(np.uint64)
        f = exact_dedup.build_filter(keys)
        assert exact_dedup.probe_filter(keys, *f).all()
        other = np.random.default_rng(n + 1).integers(0, 1 << 63, 20000).astype(np.uint64)
        assert exact_dedup.probe_filter(other, *f).mean() < 0.02


# ------------------------------------------------------------------------- op7
def test_language(spark, empty):
    de, en = ["schnell", "und", "über", "straße", "nicht"], ["quick", "and", "over", "street", "the"]
    rows = [(i, " ".join(random.Random(i).choices(de if i % 2 else en, k=40)), "de" if i % 2 else "en", "s") for i in range(120)]
    odd = [(200, None, "en", "s"), (201, "", "de", "s"), (202, "123 !?", "en", "s"), (203, rows[0][1] * 300, None, "s"), (204, "und", None, "s")]
    table = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    dictionaries = zstd_lang.train(table, table.doc_id % 5 != 0)
    assert set(dictionaries) == {"de", "en"}
    got = rows_of(zstd_lang.predict(table, dictionaries))
    assert all(got[i]["lang_pred"] == lang for i, _, lang, _ in rows) and got[203]["lang_pred"] == "en"
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (200, 201, 202))
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert zstd_lang.train(empty, empty.doc_id > 0) == {} and zstd_lang.predict(empty, {}).count() == 0


# ------------------------------------------------------------------------- op8
def test_secrets(spark, empty):
    r = random.Random(5)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    hexes = ["".join(r.choice("0123456789abcdef") for _ in range(40)) for _ in range(20)]
    rows = [(i, f"{prose(50, i)} Token = \"{h}\" {prose(20, i)}") for i, h in enumerate(hexes)]
    loose = "".join(r.choice(alnum) for _ in range(40))
    rows += [(50, f"see {loose} here"), (51, "a" * 23 + " " + "b" * 24), (52, None), (53, ""), (54, "password: abc pw api_key=xyz123 é AKIA" + "A1" * 8),
             (55, " ".join(WORDS[:60]) + " internationalisation_of_identifiers")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    ratio = markov_secrets.train(table.where("doc_id <> 50"))     # the loose string is not a training sample
    got = rows_of(markov_secrets.digest(markov_secrets.scan(table, ratio)))
    assert all(got[i]["n_assign"] == 1 and got[i]["n_hex"] == 1 for i in range(20))
    assert got[50]["spans"] == "markov:4:44" and got[50]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[51]["spans"] == "hex:24:48" and got[52]["spans"] == got[53]["spans"] == ""
    assert got[54]["n_assign"] == 1 and got[54]["n_access"] == 1 and got[55]["n_markov"] == 0
    assert markov_secrets.scan(empty, markov_secrets.train(empty)).count() == 0


def test_secret_beside_base_span(spark):
    r = random.Random(6)
    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    value = lambda: "".join(r.choice(alnum) for _ in range(40))     # noqa: E731
    rows = [(i, f"{prose(50, i)} Token = \"{value()}\" {prose(20, i)}") for i in range(20)]
    ratio = markov_secrets.train(spark.createDataFrame(rows, "doc_id long, text string"))
    access, hexa, loose = "AKIA" + "A1" * 8, "0123456789abcdef" * 2 + "01234567", value()
    assert markov_secrets.spans(f"{access}/{loose}", ratio) == [(0, 20, "access"), (20, 61, "markov")]
    assert markov_secrets.spans(f"{loose}/{hexa}/{loose}", ratio) == [(0, 41, "markov"), (41, 81, "hex"), (81, 122, "markov")]


# ------------------------------------------------------------------------- op9
def brute_components(texts, width, num, den):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append(set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else ({tuple(w)} if w else set()))
    comp = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and den * len(a & b) >= num * len(a | b):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    return [(len(s), c) for s, c in zip(sets, comp)]


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_partenum_equals_brute_force(spark, docs, empty, width, num):
    got = rows_of(partenum_join.jaccard_components(spark, docs, width, num, 100))
    for i, want in enumerate(brute_components(TEXTS, width, num, 100)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, i
    assert partenum_join.jaccard_components(spark, empty, width, num, 100).count() == 0


def test_partenum_near_copies(spark, monkeypatch):
    monkeypatch.setattr(partenum_join, "REFINE", 5)          # refinement on a small table
    texts = [edited(prose(90, 40 + i % 2), i % 9, i) for i in range(60)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(partenum_join.jaccard_components(spark, table, 3, 90, 100))
    for i, want in enumerate(brute_components(texts, 3, 90, 100)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, i


def test_partenum_equal_sets_go_on_once(spark, monkeypatch):
    """Copies of a text (and texts with the same shingles) sign nothing beyond what the smallest of them does."""
    seen, put = set(), partenum_join.Scratch.put

    def noted(self, df, name):
        out = put(self, df, name)
        if name == "members0":
            seen.update(r["doc_id"] for r in out.select("doc_id").collect())
        return out

    monkeypatch.setattr(partenum_join.Scratch, "put", noted)
    base = prose(90, 3)
    texts = [edited(base, 2, 0)] + [base] * 30 + [base.upper()] * 3 + [edited(base, 2, 1), "", None, "one", "one", prose(60, 8)]
    other = prose(70, 9)
    rows = list(enumerate(texts)) + [(50, base), (50, other), (51, other), (52, edited(other, 1, 1))]
    table = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3), "doc_id long, text string")
    got = rows_of(partenum_join.jaccard_components(spark, table, 3, 90, 100))
    for i, want in enumerate(brute_components(texts, 3, 90, 100)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, i
    # document 50 has two texts, so it goes on beside the smallest copy of the first, and joins both groups
    assert {got[i]["component_id"] for i in (50, 51, 52)} == {got[1]["component_id"]}
    assert not seen & set(range(2, 34))


@pytest.mark.parametrize("tries,rounds", [(partenum_join.TRIES, 1), (1, 6)])
def test_partenum_large_families_meet_in_few_rounds(spark, monkeypatch, tries, rounds):
    """Members outside a group's largest component, more than a task holds: no round is repeated for them."""
    steps, put = set(), partenum_join.Scratch.put

    def noted(self, df, name):
        if name.startswith("new"):
            steps.add(int(name[3:]))
        return put(self, df, name)

    monkeypatch.setattr(partenum_join.Scratch, "put", noted)
    monkeypatch.setattr(partenum_join, "REFINE", 4)
    monkeypatch.setattr(partenum_join, "TRIES", tries)
    monkeypatch.setattr(partenum_join, "GROWTH", 2)
    base = prose(150, 3)
    texts = [edited(base, 3 + i % 6, i) for i in range(36)]                 # next to none of them link with each other
    texts += [edited(texts[i], 1, 70 + i) for i in range(0, 12, 2)] + [edited(base, i % 2, 90 + i) for i in range(9)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = rows_of(partenum_join.jaccard_components(spark, table, 3, 90, 100))
    for i, want in enumerate(brute_components(texts, 3, 90, 100)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, i
    assert steps and max(steps) <= rounds


def test_partenum_block_offers_every_pair():
    """Held members against passing ones: tiles, batches, tries; nothing but what was reported as more is missing."""
    rng = np.random.default_rng(4)
    base = np.unique(rng.integers(1, 1 << 63, 60).astype(np.uint64))
    sets = [np.union1d(rng.permutation(base)[int(rng.integers(0, 5)):], rng.integers(1, 1 << 63, 1).astype(np.uint64))
            for _ in range(50)]
    sets += [np.union1d(s[1:], rng.integers(1, 1 << 63, 1).astype(np.uint64)) for s in sets[:10]]

    def row(i, comp):
        bits = np.bincount((sets[i] >> np.uint64(20)) % np.uint64(partenum_join.ODD * 64), minlength=partenum_join.ODD * 64)
        odd = np.packbits(bits.astype(np.uint8) & 1).tobytes()
        count = np.bincount(sets[i] % np.uint64(partenum_join.SKETCH), minlength=partenum_join.SKETCH).astype(np.uint8)
        return dict(sig=5, block=0, doc_id=i, comp=comp, in_top=comp == 0, size=len(sets[i]), most=len(sets[i]), odd=odd,
                    sketch=count.tobytes())

    import pyarrow as pa
    comp = [0 if i < 20 else 10 + i // 3 for i in range(len(sets))]
    rows = sorted((row(i, c) for i, c in enumerate(comp)), key=lambda r: (r["comp"], r["doc_id"]))
    rows = [r | {"passing": False} for r in rows if not r["in_top"]] + [r | {"passing": True} for r in rows]
    names = ["sig", "block", "passing", "doc_id", "comp", "in_top", "size", "most", "odd", "sketch"]
    link = lambda x, y, both: 100 * both >= 90 * (len(x) + len(y) - both)           # noqa: E731
    wanted = {(i, j) for i in range(len(sets)) for j in range(i) if comp[i] != comp[j]
              and link(sets[i], sets[j], len(np.intersect1d(sets[i], sets[j])))}
    wanted = {(j, i) for i, j in wanted}
    assert len(wanted) > 20
    batches = [pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows[k:k + 13]]) for k in range(0, len(rows), 13)]
    offers = {}
    for tries in (1, 100):
        out = [r for b in partenum_join._meet_batches(90, 100, tries)(iter(batches)) for r in b.to_pylist()]
        offers[tries] = {(r["a"], r["b"]) for r in out if r["a"] is not None}
        assert [r["sig"] for r in out if r["a"] is None] == [5] * (tries == 1)
    assert wanted <= offers[100] and offers[1] < offers[100]
    # one of each component is offered
    held = lambda pairs: {(h, comp[p]) for x in pairs for h, p in (x, x[::-1]) if comp[h]}      # noqa: E731
    assert {c for _, c in held(offers[1])} == {c for _, c in held(offers[100])}


def test_partenum_links_across_slices(spark):
    """Documents 0 and 2 link, 0 and 1 do not; 1 and 2 lie in one slice and 1 holds all signatures that 0 and 2 share."""
    words = [f"w608x{k}" for k in range(10)]
    texts = [" ".join(["p"] + words[1:]), " ".join(words[:1] + ["q"] + words[2:]), " ".join(words)]
    table = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(texts)), 2), "doc_id long, text string")
    got = rows_of(partenum_join.jaccard_components(spark, table, 1, 80, 100))
    for i, want in enumerate(brute_components(texts, 1, 80, 100)):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == want, i


def test_partenum_copies_of_frequent_texts_sign_all_elements():
    """Sets that consist of frequent elements share signatures with their own near copies, not with all such sets."""
    rng = np.random.default_rng(9)
    draw = lambda n: np.unique(rng.integers(1, 1 << 63, n).astype(np.uint64))       # noqa: E731
    edit = lambda x, n: np.union1d(rng.permutation(x)[n:], draw(n))                 # noqa: E731
    for num in (80, 90):
        bases = [draw(150) for _ in range(6)]
        scheme = partenum_join.Scheme(num, 100, 0, np.unique(np.concatenate(bases)))
        signed = [scheme.signatures(edit(b, 2)) for b in bases]
        for i, x in enumerate(signed):
            assert all(len(np.intersect1d(x, y)) == 0 for y in signed[:i])
        # a linked pair shares a signature whatever part of it is frequent
        for trial in range(150):
            x = draw(int(rng.integers(1, 220)))
            y = edit(x, int(rng.integers(0, len(x) * (100 - num) // (100 + num) + 1)))
            both = len(np.intersect1d(x, y))
            pool = np.union1d(x, y)
            for share in (0.0, 0.5, 0.9, 1.0):
                scheme = partenum_join.Scheme(num, 100, trial, np.sort(rng.permutation(pool)[:int(share * len(pool))]))
                if 100 * both >= num * (len(x) + len(y) - both):
                    assert len(np.intersect1d(scheme.signatures(x), scheme.signatures(y))), (num, trial, share)


# ------------------------------------------------------------------------ op10
def test_epsilon_grid_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    x = base[rng.integers(0, 30, 700)] + rng.normal(scale=0.08, size=(700, 16))
    x[:300] = x[0]                                           # a hot vector
    label = rng.integers(0, 3, 700)
    label[:300] = 1
    rows = [(i, v.tolist(), int(k), "c") for i, (v, k) in enumerate(zip(x, label))]
    rows += [(700, None, 1, "c"), (701, [], 1, "c"), (702, [0.0] * 16, 1, "c"), (703, [float("nan")] * 16, 1, "c"),
             (704, [None] * 16, 1, "c"), (705, rows[0][1], None, "c"), (706, [1.0, 0.0], 1, "c"), (707, [2.0, 0.0], 1, "c")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n_links string")
    got = rows_of(epsilon_grid.near_duplicates(spark, table), "vec_id")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    comp = np.arange(700)
    for _ in range(700):
        new = np.minimum(comp, np.where(link, comp[None, :], 10 ** 6).min(1))
        if (new == comp).all():
            break
        comp = new
    for i in range(700):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (link[i].sum(), comp[i], comp[i] == i)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(700, 706))
    assert got[706]["n_links"] == 1 and got[707]["component_id"] == 706
    assert epsilon_grid.near_duplicates(spark, table.limit(0)).count() == 0
