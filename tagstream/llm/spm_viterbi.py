"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The lattice's arcs are the model's pieces. ``StreamingViterbi`` keeps one
backpointer per boundary and only as many characters as a piece can span: as
soon as the paths from every boundary a later piece may still start at run
through one common boundary, the ids up to it are final and are given out. So
memory is bounded by the longest piece, whatever the text's length.

Two arc rules, chosen by the model file:

* unigram model: the arc into a boundary is the one with the largest sum of
  piece scores (the classic Viterbi step);
* BPE model: of the arcs into a boundary the one whose piece is compatible
  with the piece before it, i.e. merging the two pieces' characters by rank
  gives back exactly these two pieces. A sequence whose neighbours are all
  compatible is the merge result itself, so the path is the library's encoding.

Where no piece holds two neighbouring characters every path runs through the
boundary between them; texts are cut there and short cuts are memoised.

Defined cases: a null or empty text has no ids; characters the model lacks
become byte pieces (or the unknown id without byte fallback); U+2581 in a text
decodes to a space, as the model writes spaces that way; rows that repeat and
other columns do not matter: only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

SPACE = "▁"
SHORT = 48            # cuts up to this length are memoised
MEMO = 800_000        # entries of a worker's memo (some 200 MB) before it starts anew
FITS = 400_000        # remembered piece pairs (some 40 MB) before they start anew
OTHER = -1            # a character without a piece


class PieceModel:
    """Pieces, scores and flags of a SentencePiece model file's bytes."""

    def __init__(self, raw: bytes) -> None:
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(raw)
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        self.bpe = proto.trainer_spec.model_type == 2
        self.prefix = norm.add_dummy_prefix
        self.unk = 0
        self.pieces, self.bytes_of, self.score, self.byte_id = {}, [], [], {}
        for i, p in enumerate(proto.pieces):
            self.score.append(p.score)
            self.bytes_of.append(p.piece.replace(SPACE, " ").encode() if p.type in (1, 4, 5) else b"")
            if p.type in (1, 4, 5):
                self.pieces[p.piece] = i
            elif p.type == 2:
                self.unk = i
                self.bytes_of[i] = " ⁇ ".encode()
            elif p.type == 6:
                b = int(p.piece[3:5], 16)
                self.byte_id[b] = i
                self.bytes_of[i] = bytes([b])
        self.longest = max(map(len, self.pieces), default=1)
        self.unk_score = min((self.score[i] for i in self.pieces.values()), default=0.0) - 10.0
        # finds every piece that ends at a character, longest first
        self.matcher = ahocorasick.Automaton()
        for piece, i in self.pieces.items():
            self.matcher.add_word(piece, (len(piece), i))
        if self.pieces:
            self.matcher.make_automaton()
        self.names = {i: p for p, i in self.pieces.items()}
        self.known_fits: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int, float] | None] = {}
        self.cut = self._cutter()

    def _cutter(self) -> re.Pattern | None:
        """A pattern whose matches end only where no piece can span the boundary."""
        multi = [p for p in self.pieces if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in multi):
            return None
        heads = {c for p in self.pieces for c in p if not c.isalnum() and c != SPACE}
        while True:
            bad = {b for p in multi for a, b in zip(p, p[1:]) if b in heads and a not in heads and a != SPACE}
            if not bad:
                break
            heads -= bad
        alone = [c for c in "\n\t\r" if c not in self.pieces and not any(c in p for p in multi)]
        q = "".join(map(re.escape, sorted(heads)))
        n = "".join(map(re.escape, alone))
        q_run = f"[{q}]" if q else "(?!)"
        rest = f"[^{SPACE}{q}{n}]"
        lone = f"[{n}]|" if n else ""
        return re.compile(f"{lone}{SPACE}+{q_run}*{rest}*|{q_run}+{rest}*|{rest}+")

    def fits(self, left: int, right: int) -> bool:
        """BPE rule: do the characters of the two pieces merge back to exactly these two?"""
        if left == OTHER:
            out = self._merged(self.names[right]) == [right]
        elif self._halves(left) and self._halves(right):
            out = not self._crosses(left, right)
        else:
            out = self._merged(self.names[left] + self.names[right]) == [left, right]
        if len(self.known_fits) >= FITS:
            self.known_fits.clear()
        self.known_fits[left << 32 | right] = out
        return out

    def _halves(self, piece: int) -> tuple[int, int, float] | None:
        """The two pieces of a piece's last merge and its rank; None unless it is built by merges of rising rank.

        A single character is its own halves, with rank -1.
        """
        if piece not in self.halves:
            name, out = self.names[piece], None
            if len(name) == 1:
                out = (piece, piece, -1.0)
            else:
                parts = self._merged(name, stop=2)
                if len(parts) == 2 and OTHER not in parts:
                    below = [self._halves(i) for i in parts]
                    if all(below) and max(h[2] for h in below) < -self.score[piece]:
                        out = (parts[0], parts[1], -self.score[piece])
            self.halves[piece] = out
        return self.halves[piece]

    def _crosses(self, a: int, b: int) -> bool:
        """Does a merge join the two pieces' ends before both are complete?

        Walks back in time over the symbols that touch the boundary. Their merge
        happens if it ranks before the merge that takes the left symbol up, and
        not after the one that takes the right symbol up (equals go leftmost).
        """
        score, names, pieces = self.score, self.names, self.pieces
        until_a = until_b = float("inf")
        while True:
            joint = pieces.get(names[a] + names[b])
            if joint is not None and -score[joint] < until_a and -score[joint] <= until_b:
                return True
            (_, a_right, a_rank), (b_left, _, b_rank) = self._halves(a), self._halves(b)
            if a_rank < 0 and b_rank < 0:
                return False
            if a_rank > b_rank:
                a, until_a = a_right, a_rank
            else:
                b, until_b = b_left, b_rank

    def _merged(self, text: str, stop: int = 1) -> list[int]:
        """Ids after merging neighbouring symbols by score, leftmost first among equals, down to ``stop`` symbols."""
        parts = list(text)
        while len(parts) > stop:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.pieces.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, at = self.score[i], k
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.pieces.get(p, OTHER) for p in parts]

    def char_ids(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "replace")] if self.byte_id else [self.unk]


class StreamingViterbi:
    """Feed characters, receive ids as soon as they are final."""

    def __init__(self, model: PieceModel) -> None:
        self.m = model
        self.text = ""                       # characters after the last committed boundary
        self.back: list[tuple[int, int]] = [(0, OTHER)]   # per boundary: start and id of its arc
        self.best = [0.0]
        self.last = OTHER                    # id before the committed boundary

    @property
    def window(self) -> int:
        return len(self.text)

    def feed(self, chars: str) -> list[int]:
        out: list[int] = []
        room = 4 * self.m.longest
        for lo in range(0, len(chars), room):
            self._extend(chars[lo:lo + room])
            out += self._commit(self._meeting())
        return out

    def finish(self) -> list[int]:
        out = self._commit(len(self.text))
        self.__init__(self.m)
        return out

    def segment(self, chars: str) -> list[int]:
        """Ids of one whole short cut; the stream must be at its start."""
        self._extend(chars)
        out = self._path(len(chars))
        self.text, self.back, self.best = "", [(0, OTHER)], [0.0]
        return out

    def _extend(self, chars: str) -> None:
        m, text, old = self.m, self.text + chars, len(self.text)
        if m.pieces:
            arcs = m.matcher.iter(text, max(0, old + 1 - m.longest)) if old else m.matcher.iter(text)
        else:
            arcs = ()
        (self._bpe_arcs if m.bpe else self._best_arcs)(arcs, old, len(text))
        self.text = text

    def _bpe_arcs(self, arcs, old: int, n: int) -> None:
        """The compatible arc into each new boundary; ``arcs`` come by end, longest first."""
        back, last, known, fits = self.back, self.last, self.m.known_fits.get, self.m.fits
        done = old                       # boundaries up to here have their arc
        for end, (length, p) in arcs:
            if end < done:
                continue
            while done < end:            # characters without a piece
                back.append((done, OTHER))
                done += 1
            start = end + 1 - length
            if start < 0:
                continue
            left = back[start][1] if start else last
            ok = known(left << 32 | p)
            if ok or (ok is None and (length == 1 or fits(left, p))):
                back.append((start, p))
                done = end + 1
        for i in range(done, n):
            back.append((i, OTHER))

    def _best_arcs(self, arcs, old: int, n: int) -> None:
        """The arc with the largest score sum into each new boundary; ties go to the longest piece."""
        back, best, score, unk = self.back, self.best, self.m.score, self.m.unk_score
        found: list[list[tuple[int, int]]] = [[] for _ in range(n - old)]
        for end, (length, p) in arcs:
            if end >= old and length <= end + 1:
                found[end - old].append((end + 1 - length, p))
        for i in range(old, n):
            top, arc = float("-inf"), (i, OTHER)
            for start, p in found[i - old]:
                if best[start] + score[p] > top:
                    top, arc = best[start] + score[p], (start, p)
            if arc[0] != i or arc[1] == OTHER:
                single = any(start == i for start, _ in found[i - old])
                if not single and best[i] + unk > top:
                    top, arc = best[i] + unk, (i, OTHER)
            back.append(arc)
            best.append(top)

    def _meeting(self) -> int:
        """The last boundary that the paths from every boundary still open to a later piece run through."""
        n = len(self.text)
        live = set(range(max(0, n - self.m.longest + 1), n + 1))
        while len(live) > 1:
            far = max(live)
            live.remove(far)
            live.add(self.back[far][0])
        return live.pop()

    def _path(self, to: int) -> list[int]:
        """Ids of the path from the committed boundary to the boundary ``to``."""
        out, i, back = [], to, self.back
        while i > 0:
            start, p = back[i]
            if p != OTHER:
                out.append(p)
            elif self.m.byte_id:
                out += self.m.char_ids(self.text[i - 1])[::-1]
            elif not out or out[-1] != self.m.unk:     # neighbouring unknown characters share one id
                out.append(self.m.unk)
            i = start
        out.reverse()
        return out

    def _commit(self, to: int) -> list[int]:
        out = self._path(to)
        if to:
            self.last = self.back[to][1]
            self.text = self.text[to:]
            self.back = [(0, self.last)] + [(max(0, s - to), p) for s, p in self.back[to + 1:]]
            if not self.m.bpe:
                base = self.best[to]
                self.best = [x - base for x in self.best[to:]]
        return out


class _Memo(dict):
    """Short cut -> its ids as int32 bytes, computed on first use; a full memo starts anew, also within a text."""

    def __init__(self, model: PieceModel, entries: int) -> None:
        super().__init__()
        self.stream, self.entries = StreamingViterbi(model), entries

    def __missing__(self, chunk: str) -> bytes:
        if len(chunk) <= SHORT:
            ids = array("i", self.stream.segment(chunk)).tobytes()
            if len(self) >= self.entries:
                self.clear()
            self[chunk] = ids
            return ids
        ids = self.stream.feed(chunk) + self.stream.finish()   # a long run is streamed and not kept
        return array("i", ids).tobytes()


class Codec:
    """Encoder and decoder of one model; workers keep one per model."""

    def __init__(self, raw: bytes, memo: int = MEMO) -> None:
        self.model = PieceModel(raw)
        self.memo = _Memo(self.model, memo)

    def encode(self, text: str) -> bytes:
        """The text's ids as int32 bytes."""
        if not text:
            return b""
        text = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
        if self.model.cut is None:
            return self.memo.__missing__(text) if len(text) > SHORT else self.memo[text]
        return b"".join(map(self.memo.__getitem__, self.model.cut.findall(text)))

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.model.bytes_of.__getitem__, ids))
        if self.model.prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


_CODECS: dict[tuple[bytes, int], Codec] = {}


def codec(raw: bytes, memo: int = MEMO) -> Codec:
    key = hashlib.md5(raw).digest(), memo
    if key not in _CODECS:
        _CODECS[key] = Codec(raw, memo)
    return _CODECS[key]


def read_model(path: str) -> bytes:
    """The model file's bytes (half a megabyte); they travel with the tasks, so executors need no local file."""
    with open(path, "rb") as f:
        return f.read()


def _int_lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) // 4 for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)),
                                    pa.array(np.frombuffer(b"".join(parts), np.int32)))


def encode(docs: DataFrame, model_path: str, verify: bool = False, memo: int = MEMO) -> DataFrame:
    """(doc_id, n_ids, ids) per row of ``docs(doc_id, text)``; ``memo``: short cuts that a worker remembers.

    With ``verify`` also ``restored``: the ids decode to the text itself (null
    counts as empty).
    """
    raw = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw, memo)
        for b in batches:
            step = 256
            for lo in range(0, len(b), step):
                part = b.slice(lo, step)
                texts = [t or "" for t in part.column(1).to_pylist()]
                parts = [own.encode(t) for t in texts]
                cols = [part.column(0), pa.array([len(p) // 4 for p in parts], pa.int64()), _int_lists(parts)]
                names = ["doc_id", "n_ids", "ids"]
                if verify:
                    cols.append(pa.array([own.decode(np.frombuffer(p, np.int32).tolist()) == t
                                          for p, t in zip(parts, texts)]))
                    names.append("restored")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, n_ids long, ids array<int>" + (", restored boolean" if verify else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) per row of ``rows(doc_id, ids)``; null or empty ids give an empty text."""
    raw = read_model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(raw)
        for b in batches:
            texts = [own.decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
