"""Suffix-array deduplication by merging Burrows-Wheeler transforms.

Every byte covered by a string of ``WINDOW`` bytes that also starts earlier
(smaller doc_id, or same document and earlier start) is removed; strings are
judged on the input and never cross documents.

Spark deals the work by content: each window belongs to its minimizer, the
32-byte piece with the smallest hash in it, so equal windows meet under one
key. Consecutive windows with the same minimizer travel as one segment. A first
scan counts minimizers; only segments whose minimizer occurs more than once
(screened by a bit table of bounded size) are shuffled. Segments of equal
content are collapsed before the shuffle and again after it: all but the first
are repeats outright. A minimizer with more than ``HOT`` segments would gather
too many different ones in one task (the edges of a passage that many documents
share carry each document's own surroundings), so its segments are dealt window
by window, keyed by the whole window: such a key has one content, at most one
row a slice. For the others a task builds the Burrows-Wheeler
transform of bounded shards of segments and merges them by iterative interleave
refinement (Holt and McMillan 2014): round k reorders the interleave by one more
preceding symbol, so after it the suffixes of all shards stand sorted by k
symbols and the block borders give their common prefixes, without sorting the
suffixes of all shards again. After ``WINDOW`` rounds the blocks are the
repeated intervals; of each the earliest window stays.

Defined cases: a null text is empty; texts shorter than the window lose
nothing; a null doc_id counts as smaller than any other, so such a text is earliest;
rows that repeat a doc_id (or have none) stand at the same place, neither is earlier;
overlapping repeats count; an empty table gives an empty result; only doc_id
and text are read. What is left of a text may end inside a UTF-8 character, so
it is kept as bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm.common import Scratch, TextBatch, mix64

WINDOW = 100
PIECE = 32                 # bytes of a minimizer (a multiple of 8)
SHARD = 1 << 15            # symbols of a shard whose transform is built by sorting
CHUNK = 1 << 21            # segment bytes that a task merges at once (a larger key is merged alone)
HOT = 4096                 # segments of a minimizer from which they are dealt window by window
SPREAD = 1 << 16           # windows that are dealt at once
BITS_PER_KEY = 16          # of the bit table that screens segments
MAX_BITS = 1 << 28         # 32 MB; beyond that more segments pass the screen, no result changes
END = 0xFF                 # never a byte of UTF-8

_ODD = [np.uint64(0x9E3779B97F4A7C15)]


# ------------------------------------------------------------------- segments
def _pieces(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the PIECE bytes that start at each place."""
    n = len(x) - 7
    eight = np.empty(n, np.uint64)
    for r in range(min(8, n)):
        part = x[r:r + (len(x) - r) // 8 * 8].view("<u8") if (len(x) - r) >= 8 else np.zeros(0, np.uint64)
        eight[r::8] = part[:len(eight[r::8])]
    h = np.zeros(len(x) - PIECE + 1, np.uint64)
    for k in range(0, PIECE, 8):
        h = mix64(h * _ODD[0] + eight[k:k + len(h)])
    return h


def runs(x: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, minimizer hash, minimizer's place) of each run in the bytes ``x`` of texts that stop at ``ends``."""
    if len(x) < WINDOW:
        return (np.zeros(0, np.int64),) * 4
    h = _pieces(np.ascontiguousarray(x))
    width = WINDOW - PIECE + 1
    place = np.arange(len(h), dtype=np.uint64)
    low = (h & ~np.uint64((1 << 24) - 1)) | place          # smallest hash, then leftmost
    span = 1
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[:len(low) - (width - span)], low[width - span:])
    at = (low & np.uint64((1 << 24) - 1)).astype(np.int64)
    start = np.arange(len(at))
    owner = np.searchsorted(ends, start, side="right")
    good = start + WINDOW <= ends[np.minimum(owner, len(ends) - 1)]
    new = good.copy()
    new[1:] &= ~(good[:-1] & (at[1:] == at[:-1]) & (owner[1:] == owner[:-1]))
    first = np.flatnonzero(new)
    stop = np.concatenate([first[1:], [len(at)]])
    total = np.concatenate([[0], np.cumsum(good)])
    return first, total[stop] - total[first], mix64(h[at[first]]).astype(np.int64), at[first]


def _blocks(text: TextBatch) -> Iterator[tuple[int, int, int, int]]:
    """(first row, end row, first byte, end byte): slices of rows; a very long text in overlapping parts."""
    for lo, hi in text.slices():
        b, e = int(text.offsets[lo]), int(text.offsets[hi])
        step = 1 << 23
        if e - b <= step:
            yield lo, hi, b, e
        else:                               # one long text
            for k in range(b, max(b + 1, e - WINDOW + 1), step):
                yield lo, hi, k, min(e, k + step + WINDOW - 1)


def _slice_runs(text: TextBatch, lo: int, hi: int, b: int, e: int):
    """The slice's bytes; of each run the row, first window (in the slice, in the text), windows, minimizer and its offset."""
    x = text.data[b:e]
    ends = np.minimum(text.offsets[lo + 1:hi + 1], e) - b
    first, count, key, at = runs(x, ends)
    row = np.searchsorted(ends, first, side="right")
    return x, row + lo, first, first + b - text.offsets[lo + row], count, key, at - first


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = TextBatch(b.column(0))
        for lo, hi, s, e in _blocks(text):
            key, n = np.unique(_slice_runs(text, lo, hi, s, e)[5], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])


def screen(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bit table holding every minimizer that occurs more than once; its size is bounded. And the sorted hot ones."""
    found = (docs.select("text").mapInArrow(_count_batches, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where("n > 1"))
    scratch = Scratch(docs.sparkSession, "bwt-screen")
    keys = scratch.put(found, "keys")
    bits = 1 << 12
    while bits < min(MAX_BITS, BITS_PER_KEY * keys.count()):
        bits *= 2
    slot = F.col("key").bitwiseAND(bits - 1)
    parts = (keys.select(F.shiftright(slot, 15).alias("part"), slot.bitwiseAND((1 << 15) - 1).alias("bit"))
             .groupBy("part").applyInPandas(_bit_part, "part long, bits binary").collect())   # 4 KB a row, bits / 8 in all
    table = np.zeros(bits >> 3, np.uint8)
    for r in parts:
        whole = np.frombuffer(r["bits"], np.uint8)[:len(table)]
        table[r["part"] << 12:(r["part"] << 12) + len(whole)] = whole
    # one key for HOT segments of the input at most
    hot = keys.where(F.col("n") > HOT).select("key").toPandas()["key"].to_numpy(np.int64)
    return table, np.sort(hot)


def _bit_part(pdf: pd.DataFrame) -> pd.DataFrame:
    flags = np.zeros(1 << 15, bool)
    flags[pdf["bit"].to_numpy()] = True
    return pd.DataFrame([{"part": pdf["part"].iloc[0], "bits": np.packbits(flags, bitorder="little").tobytes()}])


def _has(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    slot = key & (len(table) * 8 - 1)
    return (table[slot >> 3] >> (slot & 7).astype(np.uint8)) & np.uint8(1) == 1


SEGMENT = "key long, doc_id long, start long, size long, seg binary, at int"


def _collapse(content: list, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's content, the row that stands first among those with that content)."""
    order = np.lexsort((start, doc))
    seen: dict = {}
    number = np.empty(len(doc), np.int64)
    first = []
    for i in order.tolist():
        k = seen.setdefault(content[i], len(seen))
        if k == len(first):
            first.append(i)
        number[i] = k
    return number, np.array(first, np.int64)


def _window_keys(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the windows that start at the places ``at`` of ``x``."""
    h = _pieces(np.ascontiguousarray(x))
    out = np.zeros(len(at), np.uint64)
    for k in [*range(0, WINDOW - PIECE, PIECE), WINDOW - PIECE]:
        out = mix64(out * _ODD[0] + h[at + k])
    return out.astype(np.int64)


def _window_batches(x: np.ndarray, raw: bytes, first: np.ndarray, doc: np.ndarray, place: np.ndarray,
                    count: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The windows of segments as segments of their own, keyed by content; repeats in a block as stretches without bytes."""
    block = (np.cumsum(count) - count) // SPREAD
    for k in np.unique(block):
        own = np.flatnonzero(block == k)
        n = count[own]
        off = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        f, d, p = (np.repeat(c[own], n) for c in (first, doc, place))
        f, p = f + off, p + off
        seg = [raw[i:i + WINDOW] for i in f.tolist()]
        number, lead = _collapse(seg, d, p)
        head = lead[number]
        same = (d == d[head]) & (p == p[head])
        new = np.flatnonzero(same)
        yield pa.RecordBatch.from_arrays(
            [pa.array(_window_keys(x, f[new])), pa.array(d[new]), pa.array(p[new]),
             pa.array(np.full(len(new), WINDOW, np.int64)), pa.array([seg[i] for i in new.tolist()], pa.binary()),
             pa.array(np.zeros(len(new), np.int32))], names=["key", "doc_id", "start", "size", "seg", "at"])
        edge = np.flatnonzero(~same & ~np.concatenate([[False], ~same[:-1] & (off[1:] > 0)]))
        last = np.flatnonzero(~same & ~np.concatenate([~same[1:] & (off[1:] > 0), [False]]))
        if len(edge):
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(edge), pa.int64()), pa.array(d[edge]), pa.array(p[edge]),
                 pa.array(p[last] + WINDOW - p[edge]), pa.nulls(len(edge), pa.binary()), pa.nulls(len(edge), pa.int32())],
                names=["key", "doc_id", "start", "size", "seg", "at"])


def _segment_batches(table: np.ndarray, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, ids = TextBatch(b.column(1)), np.array(b.column(0).fill_null(-1))
            for lo, hi, s, e in _blocks(text):
                x, row, first, place, count, key, at = _slice_runs(text, lo, hi, s, e)
                keep = np.flatnonzero(_has(table, key))
                if not len(keep):
                    continue
                row, first, place, size, key = row[keep], first[keep], place[keep], count[keep] + WINDOW - 1, key[keep]
                at = at[keep]
                raw = x.tobytes()
                seg = [raw[f:f + n] for f, n in zip(first.tolist(), size.tolist())]
                doc = ids[row]
                number, lead = _collapse(seg, doc, place)
                head = lead[number]
                # a segment whose content stands earlier in the slice is a repeat and needs no shuffle of its bytes
                same = (doc == doc[head]) & (place == place[head])
                spread = same & np.isin(key, hot)
                if spread.any():
                    yield from _window_batches(x, raw, *(c[spread] for c in (first, doc, place, size - WINDOW + 1)))
                    rest = np.flatnonzero(~spread)
                    key, doc, place, size, at, same = (c[rest] for c in (key, doc, place, size, at, same))
                    seg = [seg[i] for i in rest.tolist()]
                out = [seg[i] if same[i] else None for i in range(len(seg))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key, mask=~same), pa.array(doc), pa.array(place), pa.array(size), pa.array(out, pa.binary()),
                     pa.array(at, pa.int32())],
                    names=["key", "doc_id", "start", "size", "seg", "at"])
    return run


# --------------------------------------------------- Burrows-Wheeler transforms
def transform(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, transform) of one shard: segments, each closed by END; sorted to at least WINDOW symbols."""
    n = len(symbols)
    end = symbols == END
    # rank by doubling; a suffix stops at its segment's END
    stop = np.flatnonzero(end)
    left = stop[np.searchsorted(stop, np.arange(n))] - np.arange(n)       # symbols before END
    rank = symbols.astype(np.int64)
    rank[end] = -1
    span = 1
    while True:
        ahead = np.where(left >= span, np.concatenate([rank[span:], np.full(min(span, n), -1)])[:n], -1)
        order = np.lexsort((ahead, rank))
        change = np.ones(n, bool)
        change[1:] = (rank[order][1:] != rank[order][:-1]) | (ahead[order][1:] != ahead[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(change) - 1
        span *= 2
        if span >= WINDOW or change.all():
            break
        rank[end] = -1
    before = np.concatenate([np.array([END], np.uint8), symbols[:-1]])
    return order, before[order]


def merge(shards: list[tuple[np.ndarray, np.ndarray]], depth: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(place of every shard row in the merged order, block of every merged row).

    ``shards`` are (suffix order, transform). Round k turns an interleave
    sorted by k - 1 symbols into one sorted by k symbols: the rows, taken in
    interleave order, are dealt stably by the symbol before them. Two
    neighbours stay in one block while their symbols and their blocks are equal.
    END sorts as the smallest symbol.
    """
    bwt = np.concatenate([b for _, b in shards]) + np.uint8(1)     # END becomes 0
    which = np.repeat(np.arange(len(shards), dtype=np.uint16), [len(b) for _, b in shards])
    block = np.zeros(len(bwt), np.int32)
    for _ in range(depth):
        place = np.argsort(which, kind="stable")       # merged place of the shards' rows in turn
        symbol = np.empty_like(bwt)
        symbol[place] = bwt
        order = np.argsort(symbol, kind="stable")
        symbol, block, which = symbol[order], block[order], which[order]
        border = np.empty(len(bwt), bool)
        border[:1] = True
        border[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(border, dtype=np.int32) - np.int32(1)
    return np.argsort(which, kind="stable"), block


def window_classes(segments: list[bytes]) -> np.ndarray:
    """For the concatenation of ``segments``, each closed by END, the class of the window at each place."""
    shards, at, offset = [], 0, 0
    offsets = []
    while at < len(segments):
        size, stop = 0, at
        while stop < len(segments) and (stop == at or size + len(segments[stop]) + 1 <= SHARD):
            size += len(segments[stop]) + 1
            stop += 1
        symbols = np.frombuffer(b"".join(s + b"\xff" for s in segments[at:stop]), np.uint8)
        shards.append(transform(symbols))
        offsets.append(offset)
        offset += len(symbols)
        at = stop
    place, block = merge(shards)
    suffix = np.concatenate([o + off for (o, _), off in zip(shards, offsets)])
    out = np.empty(offset, np.int64)
    out[suffix] = block[place]
    return out


def _partnered(key: np.ndarray, seg: list, at: np.ndarray) -> np.ndarray:
    """Which of these different segments may share a window with another of the same key.

    A shared window holds the minimizer and half of the other bytes or more on
    one side of it, so that side must occur twice.
    """
    half = (WINDOW - PIECE) // 2
    sides: list[tuple] = []
    for k, s, a in zip(key.tolist(), seg, at.tolist()):
        left, right = s[max(0, a - half):a + PIECE], s[a:a + PIECE + half]
        sides.append(((k, 0, left) if len(left) == half + PIECE else None,
                      (k, 1, right) if len(right) == half + PIECE else None))
    count: dict = {}
    for pair in sides:
        for side in pair:
            if side:
                count[side] = count.get(side, 0) + 1
    return np.array([any(side and count[side] > 1 for side in pair) for pair in sides], bool)


def _repeats(key: np.ndarray, doc: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray, seg: list) -> list[tuple]:
    """(doc, first byte, end byte) of the repeated stretches of the segments of whole keys."""
    out = []
    number, lead = _collapse(seg, doc, start)
    head = lead[number]
    later = (doc != doc[head]) | (start != start[head])
    for i in np.flatnonzero(later).tolist():
        out.append((doc[i], start[i], start[i] + size[i]))
    # keys with several contents: the windows of the first segment of each content are compared
    keys, n = np.unique(key[lead], return_counts=True)
    lead = lead[np.isin(key[lead], keys[n > 1])]
    if len(lead):
        lead = lead[_partnered(key[lead], [seg[i] for i in lead.tolist()], at[lead])]
    if len(lead):
        parts = [seg[i] for i in lead.tolist()]
        classes = window_classes(parts)
        length = size[lead]
        base = np.concatenate([[0], np.cumsum(length + 1)])[:-1]
        count = length - WINDOW + 1
        owner = np.repeat(np.arange(len(lead)), count)
        off = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        cls = classes[base[owner] + off]
        d, p = doc[lead][owner], start[lead][owner] + off
        order = np.lexsort((p, d, cls))
        fresh = np.concatenate([[True], cls[order][1:] != cls[order][:-1]])
        origin = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        dup = np.zeros(len(order), bool)
        dup[order] = (d[order] != d[origin]) | (p[order] != p[origin])
        # runs of repeated windows of one segment
        edge = np.flatnonzero(dup & ~np.concatenate([[False], dup[:-1] & (owner[1:] == owner[:-1])]))
        last = np.flatnonzero(dup & ~np.concatenate([dup[1:] & (owner[1:] == owner[:-1]), [False]]))
        out += list(zip(d[edge], p[edge], p[last] + WINDOW))
    return out


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key -> (doc_id, lo, hi); whole keys are gathered up to CHUNK bytes."""
    def emit(found):
        d, lo, hi = (np.array(c, np.int64) for c in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(d), pa.array(lo), pa.array(hi)], names=["doc_id", "lo", "hi"])

    held: list[pa.RecordBatch] = []
    size = 0

    def flush(tables):
        t = pa.Table.from_batches(tables)
        return _repeats(*(t.column(i).to_numpy() for i in (0, 1, 2, 3, 5)), t.column(4).to_pylist())

    for b in batches:
        direct = b.filter(b.column(0).is_null())
        if len(direct):
            lo = direct.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([direct.column(1), direct.column(2), pa.array(lo + direct.column(3).to_numpy())],
                                             names=["doc_id", "lo", "hi"])
        b = b.filter(b.column(0).is_valid())
        while len(b):
            keys, sizes = b.column(0).to_numpy(), b.column(3).to_numpy()
            border = np.flatnonzero(np.concatenate([[bool(held) and held[-1].column(0)[-1].as_py() != keys[0]], keys[1:] != keys[:-1]]))
            full = border[(np.cumsum(sizes) - sizes)[border] + size >= CHUNK]
            cut = int(full[0]) if len(full) else len(b)
            if cut:
                held.append(b.slice(0, cut))
                size += int(sizes[:cut].sum())
            if len(full):
                found = flush(held)
                held, size = [], 0
                if found:
                    yield emit(found)
            b = b.slice(cut)
    if held and (found := flush(held)):
        yield emit(found)


# ---------------------------------------------------------------------- operator
def segments(docs: DataFrame) -> DataFrame:
    """The segments to compare with those of the same key; repeats within a slice without key and bytes."""
    return docs.select("doc_id", "text").mapInArrow(_segment_batches(*screen(docs)), SEGMENT)


def repeated_ranges(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, ranges): the byte ranges to remove of every document that has any (they may overlap)."""
    rows = segments(docs)
    found = (rows.repartition(F.coalesce("key", F.xxhash64("doc_id", "start"))).sortWithinPartitions("key", "doc_id", "start")
             .mapInArrow(_merge_batches, "doc_id long, lo long, hi long"))
    return found.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        text = TextBatch(b.column(1))
        ranges = b.column(2)
        lists = ranges.flatten()
        lo, hi = (lists.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)) if len(lists) else ([], [])
        ends = np.concatenate([[0], np.cumsum(ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        sizes, removed, spans, kept = [], [], [], []
        for i in range(text.n):
            raw = text[i]
            cut, n, at, parts = 0, 0, 0, []
            s, e = int(ends[i]), int(ends[i + 1])
            own = np.argsort(lo[s:e], kind="stable") + s if e > s else ()
            for k in own:
                a, z = int(lo[k]), int(hi[k])
                if a > at or not n:
                    parts.append(raw[at:a])
                    n += 1
                    cut += z - a
                    at = z
                elif z > at:
                    cut += z - at
                    at = z
            parts.append(raw[at:])
            sizes.append(len(raw)), removed.append(cut), spans.append(n), kept.append(b"".join(parts))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                                          pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                                         names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    ranges = Scratch(spark, "bwt").put(repeated_ranges(spark, docs), "ranges")
    return (docs.select("doc_id", "text").join(ranges, "doc_id", "left").select("doc_id", "text", "ranges")
            .mapInArrow(_cut_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def digest(cut: DataFrame) -> DataFrame:
    """The kept bytes as their sha-256."""
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
