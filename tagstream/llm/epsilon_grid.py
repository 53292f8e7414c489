"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors with cosine >= t lie within eps = sqrt(2 - 2t) of each other. The
vectors are rotated to principal axes, put on a grid of width eps along the
leading ones, and sorted by label and grid cell: the epsilon grid order. The
sorted sequence is cut into blocks of bounded size, blocks into a tree of
intervals. Pairs of intervals are joined recursively from the root: a pair that
is provably distant (boxes or spheres more than eps apart, no common label) is
skipped, a pair that is provably near throughout is counted as a whole, any
other is split, and two blocks are compared by one matrix product in double
precision. Only link counts and a spanning forest of a block pair leave its
task, never its pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors with a null label, link with nothing; vectors of
different length never link; repeated rows are vectors of their own (a vec_id
that occurs twice has its rows in one component); a row without a vec_id
links like any other but never names a component that has an id (its
component_id is null among such rows alone); an empty table gives an empty result; only vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch, components

BLOCK = 256          # vectors of a block
ARITY = 8            # intervals of an interval
LEADING = 8          # principal axes of the grid
PCA_WIDTH = 256      # longer vectors use the axes of largest variance, without rotation
SLACK = 1e-6         # rounding allowance of the geometric bounds


# ----------------------------------------------------------------- preparation
def _floats(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat doubles with nan for null, offsets, valid) of a list column."""
    column = column.fill_null([]) if column.null_count else column
    flat = column.flatten().cast(pa.float64())
    offsets = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))])
    return flat.to_numpy(zero_copy_only=False), offsets.astype(np.int64), np.diff(offsets) > 0


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label key, dimension, unit vector as double bytes (null when it links with nothing)."""
    for b in batches:
        flat, off, some = _floats(b.column(1))
        keys, dims, units = [], [], []
        for i, label in enumerate(b.column(2)):
            v = flat[off[i]:off[i + 1]]
            ok = some[i] and label.is_valid and bool(np.isfinite(v).all())
            top = np.abs(v).max() if ok else 0.0
            if not ok or not top:
                keys.append(None), dims.append(0), units.append(None)
                continue
            v = v / top                       # no overflow or underflow in the norm
            keys.append(f"{label.as_py()}|{len(v)}")
            dims.append(len(v))
            units.append((v / math.sqrt(float(v @ v))).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.string()), pa.array(dims, pa.int32()),
                                          pa.array(units, pa.binary())], names=["vec_id", "grp", "dim", "unit"])


def unit_vectors(vectors: DataFrame) -> DataFrame:
    return (vectors.select("vec_id", "embedding", "label")
            .mapInArrow(_unit_batches, "vec_id long, grp string, dim int, unit binary"))


def _moment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for b in batches:
        dims = b.column(0).to_numpy()
        for d in np.unique(dims):
            x = np.frombuffer(b"".join(b.column(1).filter(pa.array(dims == d)).to_pylist())).reshape(-1, d)
            n, s, q = sums.get(d, (0, 0.0, 0.0))
            sums[d] = [n + len(x), s + x.sum(0), q + (x.T @ x if d <= PCA_WIDTH else (x * x).sum(0))]
    for d, (n, s, q) in sums.items():
        values = np.concatenate([[n], s, np.ravel(q)])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), d, np.int32)), pa.array(np.arange(len(values))),
                                          pa.array(values)], names=["dim", "at", "value"])


def axes(units: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the matrix of all axes, the leading principal ones first (moments summed over all rows)."""
    rows = (units.where("unit IS NOT NULL").select("dim", "unit").mapInArrow(_moment_batches, "dim int, at long, value double")
            .groupBy("dim", "at").agg(F.sum("value").alias("value")).toPandas())
    out = {}
    for d, part in rows.groupby("dim"):
        v = part.sort_values("at")["value"].to_numpy()
        n, s, q = v[0], v[1:d + 1], v[d + 1:]
        if d <= PCA_WIDTH:
            out[int(d)] = np.linalg.eigh(q.reshape(d, d) / n - np.outer(s, s) / n ** 2)[1][:, ::-1]
        else:
            order = np.argsort(-(q / n - (s / n) ** 2))
            out[int(d)] = order
    return out


def _rotate(x: np.ndarray, own: np.ndarray) -> np.ndarray:
    return x[:, own] if own.ndim == 1 else x @ own


def _cell_batches(axis: dict[int, np.ndarray], eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = []
            for d, u in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                p = _rotate(np.frombuffer(u)[None, :], axis[d][..., :LEADING])[0]
                cells.append(np.floor(p / eps).astype(np.int64).tolist() + [0] * (LEADING - len(p)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.list_(pa.int64()))],
                                             names=["vec_id", "grp", "dim", "unit", "cell"])
    return run


def grid_order(scratch: Scratch, units: DataFrame, axis: dict[int, np.ndarray], eps: float) -> DataFrame:
    """(pos, block, vec_id, grp, dim, unit): the sequence in epsilon grid order, numbered without gaps."""
    good = units.where("unit IS NOT NULL").mapInArrow(
        _cell_batches(axis, eps), "vec_id long, grp string, dim int, unit binary, cell array<long>")
    line = scratch.put(good.orderBy("grp", "cell", "vec_id").drop("cell").withColumn("mid", F.monotonically_increasing_id()),
                       "line")
    part = F.shiftright("mid", 33)
    counts = line.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per task
    starts, at = [], 0
    for r in counts:
        starts.append((r["part"], at))
        at += r["n"]
    starts = line.sparkSession.createDataFrame(starts, "part int, start long")
    pos = F.col("start") + F.col("mid").bitwiseAND((1 << 33) - 1)
    return (line.withColumn("part", part.cast("int")).join(starts, "part").withColumn("pos", pos)
            .select("pos", F.floor(F.col("pos") / BLOCK).alias("block"), "vec_id", "grp", "dim", "unit"))


# ------------------------------------------------------------- interval tree
NODE = "node long, n long, lo_grp string, hi_grp string, box_lo array<double>, box_hi array<double>, " \
       "centre array<double>, radius double, first long"


def _leaf(axis: dict[int, np.ndarray]):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        width = max(pdf["dim"])
        x = np.zeros((len(pdf), width))        # shorter vectors padded; they differ in grp
        for i, u in enumerate(pdf["unit"]):
            x[i, :len(u) // 8] = np.frombuffer(u)
        one = pdf["grp"].iloc[0] == pdf["grp"].iloc[-1]
        lead = _rotate(x, axis[width][..., :LEADING]) if one else x[:, :0]
        centre = x.mean(0)
        return pd.DataFrame([{
            "node": pdf["block"].iloc[0], "n": len(pdf), "lo_grp": pdf["grp"].iloc[0], "hi_grp": pdf["grp"].iloc[-1],
            "box_lo": lead.min(0).tolist(), "box_hi": lead.max(0).tolist(), "centre": centre.tolist(),
            "radius": float(np.sqrt(((x - centre) ** 2).sum(1)).max()) if one else 1e9,
            "first": int(pdf["vec_id"].iloc[0])}])
    return run


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node")
    one = pdf["lo_grp"].iloc[0] == pdf["hi_grp"].iloc[-1]
    out = {"node": pdf["node"].iloc[0] // ARITY, "n": pdf["n"].sum(), "lo_grp": pdf["lo_grp"].iloc[0],
           "hi_grp": pdf["hi_grp"].iloc[-1], "box_lo": [], "box_hi": [], "centre": [], "radius": 1e9,
           "first": pdf["first"].iloc[0]}
    if one:
        c = np.stack(pdf["centre"].to_list())
        centre = (c * pdf["n"].to_numpy()[:, None]).sum(0) / pdf["n"].sum()
        out |= {"box_lo": np.stack(pdf["box_lo"].to_list()).min(0).tolist(),
                "box_hi": np.stack(pdf["box_hi"].to_list()).max(0).tolist(), "centre": centre.tolist(),
                "radius": float((np.sqrt(((c - centre) ** 2).sum(1)) + pdf["radius"].to_numpy()).max())}
    return pd.DataFrame([out])


def _squares(a: Column, b: Column, f) -> Column:
    return F.aggregate(F.zip_with(a, b, f), F.lit(0.0), lambda s, x: s + x * x)


def judged(pairs: DataFrame, nodes: DataFrame, eps: float) -> DataFrame:
    """``pairs(x, y)`` of nodes that may hold links, with ``near``: all their pairs link."""
    def side(tag):
        return nodes.select(F.col("node").alias(tag), *[F.col(c).alias(f"{tag}_{c}") for c in nodes.columns if c != "node"])

    j = pairs.join(side("x"), "x").join(side("y"), "y").where("x_hi_grp >= y_lo_grp AND y_hi_grp >= x_lo_grp")
    pure = F.expr("x_lo_grp = x_hi_grp AND y_lo_grp = y_hi_grp AND x_lo_grp = y_lo_grp")
    apart = F.sqrt(_squares(F.col("x_centre"), F.col("y_centre"), lambda a, b: a - b))
    gap = F.sqrt(F.aggregate(
        F.zip_with(F.zip_with("x_box_lo", "y_box_hi", lambda a, b: a - b),
                   F.zip_with("y_box_lo", "x_box_hi", lambda a, b: a - b), lambda a, b: F.greatest(a, b, F.lit(0.0))),
        F.lit(0.0), lambda s, v: s + v * v))
    reach = F.col("x_radius") + F.col("y_radius")
    far = pure & ((gap > eps + SLACK) | (apart - reach > eps + SLACK))
    return (j.where(~far).withColumn("near", pure & (apart + reach <= eps - SLACK))
            .select("x", "y", "near", "x_n", "y_n", "x_first", "y_first"))


# ------------------------------------------------------------------- block pairs
def _block_bytes(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("pos")
    return pd.DataFrame([{"node": pdf["block"].iloc[0], "pos": pdf["pos"].iloc[0],
                          "ids": pdf["vec_id"].astype(np.int64).to_numpy().tobytes(),
                          "grps": pdf["grp"].tolist(), "units": pdf["unit"].tolist()}])


def _forest(links: np.ndarray) -> np.ndarray:
    """For a boolean matrix, the smallest row (or own column) index every column node hangs on, by propagation."""
    n, m = links.shape
    row, col = np.arange(n), np.full(m, n)
    while True:
        new_col = np.where(links, row[:, None], n).min(0, initial=n)
        new_row = np.minimum(row, np.where(links, new_col[None, :], n).min(1, initial=n))
        if (new_row == row).all() and (new_col == col).all():
            return np.concatenate([row, col])
        row, col = new_row, new_col


def _kernel(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                a, c = r["x_units"], r["y_units"]
                links = np.zeros((len(a), len(c)), bool)
                ga, gc = np.array(r["x_grps"]), np.array(r["y_grps"])
                for g in np.intersect1d(ga, gc):
                    i, k = np.flatnonzero(ga == g), np.flatnonzero(gc == g)
                    u = np.frombuffer(b"".join(a[t] for t in i)).reshape(len(i), -1)
                    v = np.frombuffer(b"".join(c[t] for t in k)).reshape(len(k), -1)
                    links[np.ix_(i, k)] = u @ v.T >= threshold
                same = r["x"] == r["y"]
                if same:
                    np.fill_diagonal(links, False)
                if not links.any():
                    continue
                xi, yi = np.frombuffer(r["x_ids"], np.int64), np.frombuffer(r["y_ids"], np.int64)
                # within a block a vector is row and column at once
                root = _forest(links | np.eye(len(a), dtype=bool) if same else links)
                rows, cols = links.sum(1), links.sum(0)
                sides = [(rows, xi, r["x_pos"], root[:len(a)])]
                if not same:
                    sides.append((cols, yi, r["y_pos"], root[len(a):]))
                for n, ids, start, hang in sides:
                    at = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(start + at), pa.array(n[at].astype(np.int64)), pa.array(ids[at]), pa.array(xi[hang[at]])],
                        names=["pos", "n", "a", "b"])
    return run


# ---------------------------------------------------------------------- operator
def near_duplicates(spark: SparkSession, vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable by links), kept."""
    scratch = Scratch(spark, "epsilon-grid")
    eps = math.sqrt(2.0 - 2.0 * threshold)
    # rows without an id get one above all others, so they never name a component of others
    top = vectors.agg(F.max("vec_id")).first()[0]
    above = max(0, (top if top is not None else -1) + 1)
    known = F.coalesce(F.col("vec_id").cast("long"), F.lit(above) + F.monotonically_increasing_id())
    units = scratch.put(unit_vectors(vectors.withColumn("vec_id", known)), "units")

    def named(df):
        return df.select(*[F.when(F.col(c) < above, F.col(c)).alias(c) if c.endswith("_id") else c for c in df.columns])

    axis = axes(units)
    line = scratch.put(grid_order(scratch, units, axis, eps), "sequence")
    alone = (units.where("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
    total = line.count()
    if not total:
        return named(alone)
    levels = [scratch.put(line.groupBy("block").applyInPandas(_leaf(axis), NODE), "level0")]
    width = -(-total // BLOCK)
    while width > 1:
        up = levels[-1].groupBy(F.floor(F.col("node") / ARITY)).applyInPandas(_merge, NODE)
        levels.append(scratch.put(up, f"level{len(levels)}"))
        width = -(-width // ARITY)

    pairs = spark.createDataFrame([(0, 0)], "x long, y long")
    whole = []                              # pairs of intervals that link throughout, by level
    for level in range(len(levels) - 1, -1, -1):
        seen = scratch.put(judged(pairs, levels[level], eps), f"pairs{level}")
        whole.append((level, seen.where("near")))
        open_ = seen.where("NOT near").select("x", "y")
        if level:
            kid = F.sequence(F.lit(0), F.lit(ARITY - 1))
            pairs = (open_.withColumn("i", F.explode(kid)).withColumn("j", F.explode(kid))
                     .select((F.col("x") * ARITY + F.col("i")).alias("x"), (F.col("y") * ARITY + F.col("j")).alias("y"))
                     .where("x <= y"))
    blocks = scratch.put(line.groupBy("block").applyInPandas(
        _block_bytes, "node long, pos long, ids binary, grps array<string>, units array<binary>"), "blocks")

    def side(tag):
        return blocks.select(F.col("node").alias(tag), *[F.col(c).alias(f"{tag}_{c}") for c in ("pos", "ids", "grps", "units")])

    found = scratch.put(open_.join(side("x"), "x").join(side("y"), "y")
                        .mapInArrow(_kernel(threshold), "pos long, n long, a long, b long"), "found")
    counts, edges = found.select("pos", "n"), found.select("a", "b")
    for level, near in whole:
        if near.isEmpty():
            continue
        span = F.floor(F.col("block") / (ARITY ** level))
        bump = (near.select(F.explode(F.expr(
            "CASE WHEN x = y THEN array(struct(x AS node, x_n - 1 AS n, x_first AS first))"
            " ELSE array(struct(x AS node, y_n AS n, x_first AS first), struct(y, x_n, y_first)) END")).alias("e"))
            .groupBy("e.node").agg(F.sum("e.n").alias("n"), F.min("e.first").alias("first")))
        hit = line.withColumn("node", span).join(bump, "node")
        counts = counts.union(hit.select("pos", "n"))
        edges = edges.union(hit.select(F.col("vec_id"), F.col("first"))).union(near.select("x_first", "y_first"))
    sums = counts.groupBy("pos").agg(F.sum("n").alias("n_links"))
    comp = components(spark, scratch, edges)
    done = (line.select("pos", "vec_id").join(sums, "pos", "left").join(comp, F.col("vec_id") == F.col("node"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"),
                    F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept")))
    return named(done.union(alone))
