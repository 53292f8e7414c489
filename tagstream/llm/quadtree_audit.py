"""Source divergence audit: a K-squared quadtree over the group-term count matrix.

Rows of the matrix are the (lang, source) groups, columns the terms that occur
in at least ``min_docs`` documents of the language, cells the occurrences. The
matrix is cut into column stripes and blocks of rows; each tile is a quadtree
(K = 2) whose inner nodes tell whether a quadrant holds any occurrence. Two row
ranges are traversed jointly: where both have an all-zero quadrant, every pair
of their groups gets the same closed price for its columns, without visiting
them; only quadrants with occurrences are opened, down to single cells.

A cell's share is p = 1 + floor(SCALE * (count + 1) / (N + V)), N the group's
occurrences of kept terms and V the kept terms of the language; the divergence
of p from q is floor((p - q)^2 / q), summed over the kept terms. All of it is
integer arithmetic: shares as decimals in Spark, divergences as 64-bit integers
(a sum stays below (SCALE + V)^2).

Defined cases: null text, lang and source count as empty; a row is a document,
so repeated rows count each; a group without terms takes part with count 0
everywhere; a language without kept terms has pairs of value 0 and no term
rows; a language of one source has no pairs; ties rank by the UTF-8 order of
the item; an empty table gives no rows; other columns are not read. Texts of
any length are read in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch, TextBatch, trimmed

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP_TERMS = 200
STRIPE = 2048            # expected columns of a stripe
BLOCK = 64               # expected rows of a row block
READ_BYTES = 12 << 20    # text bytes counted at once
OPEN_CELLS = 1 << 20     # most (row, row, column) triples opened at once

_B = np.arange(256)
LETTER = ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)
LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)


# ------------------------------------------------------------------ term counts
def _terms(x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Start of each term in the bytes ``x``, and the terms; a term also ends before a byte marked ``first``."""
    keep = LETTER[x]
    start = keep.copy()
    start[1:] &= ~keep[:-1] | first[1:]
    starts = np.flatnonzero(start)
    data = LOWER[x[keep]]
    offsets = np.append(np.cumsum(keep)[starts] - 1, len(data)).astype(np.int64) if len(starts) else np.zeros(1, np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))
    return starts, terms.dictionary_encode()


def _blocks(x: np.ndarray, read: int) -> Iterator[np.ndarray]:
    """A long text in blocks that end between terms."""
    at = 0
    while at < len(x):
        end = min(at + read, len(x))
        while end < len(x) and LETTER[x[end]]:
            step = ~LETTER[x[end:end + 4096]]
            end += int(step.argmax()) if step.any() else len(step)
        yield x[at:end]
        at = end


def _long_text(x: np.ndarray, read: int) -> tuple[pa.Array, np.ndarray]:
    """Terms of one long text and their counts."""
    parts = []
    for block in _blocks(x, read):
        _, enc = _terms(block, np.zeros(len(block), bool))
        n = np.bincount(enc.indices.to_numpy(), minlength=len(enc.dictionary))
        parts.append(pa.table({"term": enc.dictionary, "n": pa.array(n, pa.int64())}))
        if len(parts) > 8:
            parts = [pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])]
    done = pa.concat_tables(parts).group_by("term").aggregate([("n", "sum")]).rename_columns(["term", "n"])
    return done["term"].combine_chunks(), done["n"].to_numpy()


def _counter(read: int):
    """Per slice of text: occurrences and documents of each (lang, source, term)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(langs, sources, terms, n, docs):
            return pa.RecordBatch.from_arrays(
                [langs, sources, terms.cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            texts = TextBatch(batch.column(2))
            pairs = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], names=["lang", "source"])
            seen: dict = {}
            group = np.array([seen.setdefault((v["lang"], v["source"]), len(seen)) for v in pairs.to_pylist()], np.int64)
            langs = pa.array([k[0] for k in seen], pa.string())
            sources = pa.array([k[1] for k in seen], pa.string())
            for lo, hi in texts.slices(read):
                base, end = texts.offsets[lo], texts.offsets[hi]
                x = texts.data[base:end]
                if hi == lo + 1 and len(x) > read:
                    terms, n = _long_text(x, read)
                    g = pa.array(np.full(len(n), group[lo]))
                    yield rows(langs.take(g), sources.take(g), terms, n, np.ones(len(n), np.int64))
                    continue
                begin = texts.offsets[lo:hi] - base
                first = np.zeros(len(x) + 1, bool)
                first[begin] = True
                starts, enc = _terms(x, first[:-1])
                if not len(starts):
                    continue
                doc = np.searchsorted(begin, starts, side="right") - 1
                code, size = enc.indices.to_numpy().astype(np.int64), len(enc.dictionary)
                in_doc = np.unique(doc * size + code)
                keys, n = np.unique(group[lo + doc] * size + code, return_counts=True)
                docs = np.unique(group[lo + in_doc // size] * size + in_doc % size, return_counts=True)[1]
                g, c = pa.array(keys // size), pa.array(keys % size)
                yield rows(langs.take(g), sources.take(g), enc.dictionary.take(c), n, docs)
    return run


def term_counts(docs: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that hold the term)."""
    text = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = text.mapInArrow(trimmed(_counter(read_bytes)), "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --------------------------------------------------------------------- quadtree
def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def levels(present: np.ndarray) -> list[np.ndarray]:
    """Presence bits of the quadtrees of a tile row: level 0 the cells, the last one a node for each whole tile."""
    out = [present]
    while out[-1].shape[0] > 1:
        q = out[-1]
        out.append(q.reshape(q.shape[0] // 2, 2, q.shape[1] // 2, 2).any(axis=(1, 3)))
    return out


def joint(la: list[np.ndarray], lb: list[np.ndarray], sizes: tuple[int, int, int]
          ) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Traverses the trees of two row blocks together.

    Returns the columns of each pair of rows that lie in quadrants empty for
    both, and the (row, row, column) leaves that hold an occurrence. ``sizes``:
    the rows of either block and the columns that exist, without padding.
    """
    top, side = len(la) - 1, la[0].shape[0]
    na, nb, nc = sizes
    empty = np.zeros((side, side), np.int64)
    c = np.arange(la[top].shape[1])
    a = b = np.zeros(len(c), np.int64)
    for level in range(top, -1, -1):
        span = 1 << level
        real = (a * span < na) & (b * span < nb) & (c * span < nc)
        a, b, c = a[real], b[real], c[real]
        full = la[level][a, c] | lb[level][b, c]
        width = np.minimum(span, nc - c * span)
        priced = np.zeros((side // span, side // span), np.int64)
        np.add.at(priced, (a[~full], b[~full]), width[~full])
        empty += priced.repeat(span, 0).repeat(span, 1)
        a, b, c = a[full], b[full], c[full]
        if level:
            k = np.arange(8)
            a, b, c = ((2 * v[:, None] + (k >> s & 1)).ravel() for v, s in ((a, 2), (b, 1), (c, 0)))
    return empty[:na, :nb], (a, b, c)


def block_pair(pa_: np.ndarray, ha: np.ndarray, za: np.ndarray, pb: np.ndarray, hb: np.ndarray, zb: np.ndarray,
               beyond: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Divergences of two row blocks over a stripe: of a from b, and of b from a.

    ``p``: shares, with the zero count's share where nothing occurs; ``h``:
    whether something occurs; ``z``: each row's share of a zero count; ``beyond``:
    columns of the stripe that no row of either block occurs in.
    """
    (na, nc), nb = pa_.shape, pb.shape[0]
    side = 1 << max(0, int(max(na, nb) - 1).bit_length())
    ab, ba = np.zeros((na, nb), np.int64), np.zeros((na, nb), np.int64)
    empty = np.full((na, nb), beyond, np.int64)
    step = max(side, OPEN_CELLS // (side * side) // side * side)
    for lo in range(0, nc, step):
        n = min(step, nc - lo)
        wide = -(-n // side) * side

        def tree(h):
            padded = np.zeros((side, wide), bool)
            padded[:h.shape[0], :n] = h[:, lo:lo + n]
            return levels(padded)

        priced, (a, b, c) = joint(tree(ha), tree(hb), (na, nb, n))
        empty += priced
        x, y = pa_[a, lo + c], pb[b, lo + c]
        np.add.at(ab, (a, b), divergence(x, y))
        np.add.at(ba, (a, b), divergence(y, x))
    x, y = za[:, None], zb[None, :]
    return ab + empty * divergence(x, y), ba + empty * divergence(y, x)


OUT = "lang string, source string, part string, item string, value long"


def _tile(pdf: pd.DataFrame) -> pd.DataFrame:
    """One stripe of one language for two row blocks: partial pair sums, and the stripe's leading terms."""
    head = pdf["source"].notna()
    cells, names = pdf[~head], pdf[head].sort_values("g")
    lang, x, y = names["lang"].iloc[0], int(names["x"].iloc[0]), int(names["y"].iloc[0])
    col, terms = pd.factorize(cells["term"], sort=True)
    beyond = int(names["p"].iloc[0]) - len(terms)           # columns of the stripe empty for both blocks
    k, g, share = (cells[c].to_numpy(np.int64) for c in ("k", "g", "p"))
    side = {}
    for block in {x, y}:
        rows, own = names[names["k"] == block], k == block
        r, c = np.searchsorted(rows["g"].to_numpy(np.int64), g[own]), col[own]
        zero = rows["p0"].to_numpy(np.int64)
        p = np.repeat(zero[:, None], len(terms), 1)
        p[r, c] = share[own]
        has = np.zeros(p.shape, bool)
        has[r, c] = True
        side[block] = rows["source"].to_numpy(object), p, has, zero
    out = []

    def frame(source, part, item, value):
        out.append((np.full(len(value), lang, object), source, np.full(len(value), part, object), item, value))

    (sa, *ta), (sb, *tb) = side[x], side[y]
    if len(sa) and len(sb):
        ab, ba = block_pair(*ta, *tb, beyond)
        a, b = np.nonzero(sa[:, None] != sb[None, :])
        frame(sa[a], "pair", sb[b], ab[a, b])
        if x != y:
            frame(sb[b], "pair", sa[a], ba[a, b])
    if x == y and len(cells):
        q = cells["q"].to_numpy(np.int64)
        over = share > q
        source = pd.Series(names["source"].to_numpy(object), index=names["g"].to_numpy(np.int64))
        leaf = pd.DataFrame({"g": g[over], "c": col[over], "v": divergence(share[over], q[over])})
        # terms are numbered in their UTF-8 order
        best = leaf.sort_values(["v", "c"], ascending=[False, True], kind="stable").groupby("g", sort=False).head(TOP_TERMS)
        frame(source[best["g"]].to_numpy(object), "term", np.asarray(terms, object)[best["c"]], best["v"].to_numpy())
    frame(np.zeros(0, object), "", np.zeros(0, object), np.zeros(0, np.int64))      # a tile without rows keeps the types
    return pd.DataFrame(dict(zip([c.split()[0] for c in OUT.split(", ")], map(np.concatenate, zip(*out)))))


# ---------------------------------------------------------------------- operator
def _share(n: str, total: str, terms: str) -> F.Column:
    return F.expr(f"1 + (CAST({n} AS DECIMAL(19, 0)) + 1) * {SCALE} DIV nullif(CAST({total} AS DECIMAL(19, 0)) + {terms}, 0)")


def audit(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, stripe: int = STRIPE, block: int = BLOCK,
          read_bytes: int = READ_BYTES) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank.

    ``pair``: the group's divergence from each other source of its language.
    ``term``: the kept terms that the group uses more than its language does,
    the first ``TOP_TERMS`` of them.
    """
    scratch = Scratch(spark, "quadtree")
    of_term = Window.partitionBy("lang", "term")
    counts = term_counts(docs, read_bytes).withColumns({"lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term),
                                            "head": F.col("source") == F.min("source").over(of_term)})
    kept = scratch.put(counts.where(F.col("lang_docs") >= min_docs).drop("docs", "lang_docs"), "kept")

    of_lang = kept.groupBy("lang").agg(F.count_if("head").alias("v"), F.sum("n").alias("lang_total"))
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    names = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    # languages and a language's sources by number: strings travel in the groups' own rows only
    langs = names.groupBy("lang").agg(F.count("*").alias("s")).withColumn("l", F.row_number().over(Window.orderBy("lang")))
    groups = names.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").join(langs, "lang")
    groups = groups.fillna(0, ["total", "v", "lang_total"]).withColumns({
        "p0": F.coalesce(_share("0", "total", "v"), F.lit(1)),
        "g": F.row_number().over(Window.partitionBy("lang").orderBy("source")),
        "stripes": F.greatest(F.lit(1), F.ceil(F.col("v") / stripe)),
        "blocks": F.ceil(F.col("s") / block)}).withColumn("k", F.expr("pmod(xxhash64(source), blocks)"))
    groups = scratch.put(groups, "groups")

    cells = kept.join(groups, ["lang", "source"]).select(
        "l", F.expr("pmod(xxhash64(term), stripes)").alias("stripe"), "blocks", "k", "g", "term", "head",
        _share("n", "total", "v").alias("p"), _share("lang_n", "lang_total", "v").alias("q"))
    # the columns of a stripe, also those in which neither block of a tile has an occurrence
    width = cells.where("head").groupBy("l", "stripe").agg(F.count("*").alias("width"))
    heads = groups.withColumn("stripe", F.explode(F.expr("sequence(0, stripes - 1)"))).join(width, ["l", "stripe"], "left")
    heads = heads.select("l", "stripe", "blocks", "k", "g", "lang", "source", F.coalesce("width", F.lit(0)).alias("p"), "p0")
    tiles = (cells.drop("head").unionByName(heads, allowMissingColumns=True)
             .withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)")))
             .withColumns({"x": F.least("k", "o"), "y": F.greatest("k", "o")}).drop("blocks", "o"))
    parts = scratch.put(tiles.groupBy("l", "stripe", "x", "y").applyInPandas(_tile, OUT), "parts")

    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(best)
    terms = parts.where("part = 'term'").withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS)
    return (pairs.withColumn("rank", rank).unionByName(terms)
            .select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")))
