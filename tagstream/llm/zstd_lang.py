"""Language identification by compression.

For every language a raw-content zstandard dictionary is filled with that
language's training text. A text is cut in blocks, every block is compressed
with each dictionary, and the language with the smallest total wins. The score
is the saving over the second best, (second - best) / second; a narrow margin
is rejected (``accepted`` false), the best guess is still reported.

Letters decide alone: runs of other characters become one space and letters
are lower-cased, in training and prediction.

Defined cases: a null text or one without a letter is ``und`` with score 0;
equal sizes go to the alphabetically first language with score 0; with a
single learned language the score is 1; training rows with null lang, null
text or no letter teach nothing; without any learned language every text is
``und``; repeated rows each get a row; only doc_id, text and lang are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DICT_BYTES = 112_640     # per language; the dictionaries travel with the tasks
SAMPLE_DOCS = 300        # expected training documents per language
SAMPLE_CHARS = 4_000     # of each, so that no long one fills the dictionary
BLOCK = 4_096
LEVEL = 6
MARGIN = 0.02
UNKNOWN = "und"

_OTHER = regex.compile(r"[^\p{L}]+")


def letters(text: str) -> bytes:
    """The text's letters, lower-cased, other runs as one space; empty without letters."""
    bare = _OTHER.sub(" ", text).strip(" ")
    return f" {bare.lower()} ".encode("utf-8", "replace") if bare else b""


def train(docs: DataFrame, keep) -> dict[str, bytes]:
    """Dictionary bytes per language from the rows where the column ``keep`` holds.

    Per language about ``SAMPLE_DOCS`` rows are drawn by a hash of the id (a
    documented bound on the fitting sample); only they reach the driver.
    """
    rows = docs.where(keep & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    shares = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 1.0 * SAMPLE_DOCS / n)))])
    order = F.xxhash64("doc_id", F.lit(41))
    rank = (order.cast("double") / 9223372036854775807 + 1.0) / 2.0
    picked = (rows.where(rank <= F.element_at(shares, F.col("lang")))
              .select("lang", order.alias("order"), F.substring("text", 1, SAMPLE_CHARS).alias("text"))
              .orderBy("lang", "order").collect())
    out: dict[str, bytes] = {}
    for r in picked:
        add = letters(r["text"])
        if add and len(out.get(r["lang"], b"")) < DICT_BYTES:
            out[r["lang"]] = out.get(r["lang"], b"") + add
    return {k: v[-DICT_BYTES:] for k, v in out.items()}


class Sizer:
    """Compressed sizes of a text under every language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        self.langs = sorted(dictionaries)
        self.compressors = []
        for lang in self.langs:
            params = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=BLOCK, dict_size=len(dictionaries[lang]), write_content_size=False,
                write_checksum=False, write_dict_id=False)
            d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            self.compressors.append(zstandard.ZstdCompressor(compression_params=params, dict_data=d))

    def predict(self, text: str | None) -> tuple[str, float]:
        bare = letters(text) if text else b""
        if not bare or not self.langs:
            return UNKNOWN, 0.0
        blocks = [bare[k:k + BLOCK] for k in range(0, len(bare), BLOCK)]
        sizes = [sum(len(c.compress(b)) for b in blocks) for c in self.compressors]
        ranked = sorted(zip(sizes, self.langs))
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        return ranked[0][1], (ranked[1][0] - ranked[0][0]) / ranked[1][0]


def predict(docs: DataFrame, dictionaries: dict[str, bytes]) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, accepted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = Sizer(dictionaries)
        for b in batches:
            found = [sizer.predict(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64()),
                 pa.array([s >= MARGIN for _, s in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, accepted boolean")
