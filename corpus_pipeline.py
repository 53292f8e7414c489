"""The corpus pipeline: documents -> clean, unique, mixed, tokenised documents.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents`` (the last one: the token ids). Stage results are
written as Parquet and read again as the next stage's input.

Defined cases: as in the operators; a source's missing rows are never made up,
rows repeated by the mixing stage keep their doc_id; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagstream.llm import exact_dedup, importance_resampling, partenum_join, poisson_mix, spm_viterbi
from tagstream.llm.common import Scratch, bounded_reads, table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
MIX_SEED = 17
TOKEN_MEMO = 100_000     # short cuts that a worker remembers beside what earlier stages left in its memory


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance-resampling classifier draws stay, the others go."""
    bounded_reads(spark)
    return importance_resampling.keep_sampled(spark, docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts stays."""
    bounded_reads(spark)
    return exact_dedup.keep_unique(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of 5-word shingle similarity 0.8 or more stays."""
    bounded_reads(spark)
    return partenum_join.keep_one_each(spark, docs, width=5, num=80, den=100)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to equal shares by Poisson replication, globally shuffled."""
    bounded_reads(spark)
    return poisson_mix.replicate(spark, docs, seed=MIX_SEED, copy_col=None)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids."""
    bounded_reads(spark)
    return spm_viterbi.encode(docs, TOKENIZER, memo=TOKEN_MEMO)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mix", mix), ("tokens", tokens)]

#: hashed models, near-duplicate components and token ids are beyond SQL; tests/llm/test_pipeline_run.py holds run()
#: against plain Python (the quality stage's decisions are the operator's own)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; a stage's table goes once the next one is written."""
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = scratch.put(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return STAGES[-1][1](spark, docs, sf_dir)
