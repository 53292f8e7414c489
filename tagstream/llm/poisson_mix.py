"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source of n rows with target share w of T output rows has the mean
repetition rate w * T / n. Each row inverts the Poisson distribution of that
mean at a hash-seeded uniform value, is repeated that many times, and the
copies are shuffled globally by a second hash.

Defined cases: a null source is a source of its own (named in ``weights`` by
the key None); a source that ``weights`` leaves out has weight 0 and yields
no row; weights are scaled over the sources present; rows that repeat a
doc_id draw the same count; a null doc_id is hashed as the text 'null'; an
empty table gives an empty result; the helper columns use a ``__mix_`` prefix
and other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_SOURCES = 4096    # rate rows (a few hundred bytes each) that are broadcast; above it the join is salted
SALTS = 64
PART_MEAN = 16.0                # a larger mean is a sum of independent Poisson parts of at most this mean
CHUNK = 1024                    # copies generated from one array


def uniform(seed: int, *cols: Column) -> Column:
    """A value in (0, 1) from 52 bits of an md5 over the seed and the columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("null")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("null"))


def rates(docs: DataFrame, weights: dict | None, epochs: float, source_col: str) -> DataFrame:
    """Rows (__mix_key, __mix_parts, __mix_cdf): per source the Poisson parts and the cumulative distribution of one."""
    n = docs.groupBy(_key(F.col(source_col)).alias("__mix_key")).agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("w", F.lit(1.0))
    else:
        pairs = [F.struct(F.lit("null" if k is None else f"s{k}").alias("k"), F.lit(float(v)).alias("v"))
                 for k, v in weights.items()]
        n = n.withColumn("w", F.coalesce(F.try_element_at(F.map_from_entries(F.array(*pairs)), F.col("__mix_key")),
                                         F.lit(0.0))) if pairs else n.withColumn("w", F.lit(0.0))
    w_all, n_all = n.agg(F.sum("w"), F.sum("n")).first()
    share = F.col("w") / F.lit(float(w_all or 1.0))
    n = n.withColumn("lam", share * F.lit(float(epochs) * float(n_all or 0)) / F.col("n"))
    n = n.withColumn("__mix_parts", F.greatest(F.lit(1), F.ceil(F.col("lam") / PART_MEAN)).cast("int"))
    n = n.withColumn("mean", F.col("lam") / F.col("__mix_parts"))
    # pmf terms by the recurrence p(k) = p(k-1) * mean / k, summed up as they come
    top = F.ceil(F.col("mean") + 12 * F.sqrt(F.col("mean")) + 30).cast("int")
    grow = F.aggregate(
        F.sequence(F.lit(1), top),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf")),
        lambda s, k: F.struct((s["p"] * F.col("mean") / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * F.col("mean") / k)
                                       ).alias("cdf")))
    return n.select("__mix_key", "__mix_parts", grow["cdf"].alias("__mix_cdf"), "lam")


def poisson_count(doc_id: Column, seed: int) -> Column:
    """Sum over the parts of the smallest k with cdf(k) >= u."""
    return F.aggregate(
        F.sequence(F.lit(1), F.col("__mix_parts")), F.lit(0).cast("long"),
        lambda acc, j: acc + F.size(F.filter("__mix_cdf", lambda c: c < uniform(seed, doc_id, j))))


def replicate(spark: SparkSession, docs: DataFrame, weights: dict | None = None, epochs: float = 1.0,
              seed: int = 17, source_col: str = "source", id_col: str = "doc_id",
              copy_col: str | None = "copy") -> DataFrame:
    """``docs`` with each row repeated by its Poisson count, in globally shuffled order.

    ``weights``: source -> target share (None: equal shares); ``epochs``:
    output rows per input row; ``copy_col``: name of the added 1-based copy
    number, or None to leave it out.
    """
    rate = rates(docs, weights, epochs, source_col).drop("lam")
    keyed = docs.withColumn("__mix_key", _key(F.col(source_col)))
    if rate.limit(MAX_BROADCAST_SOURCES + 1).count() <= MAX_BROADCAST_SOURCES:
        joined = keyed.join(F.broadcast(rate), "__mix_key")
    else:
        salt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(SALTS)).cast("int")
        spread = rate.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("__mix_salt", salt).join(spread, ["__mix_key", "__mix_salt"]).drop("__mix_salt")
    drawn = joined.withColumn("__mix_n", poisson_count(F.col(id_col), seed)).where("__mix_n > 0")
    drawn = drawn.drop("__mix_key", "__mix_parts", "__mix_cdf")
    # two generators, so that no array is longer than CHUNK whatever the rate is
    chunks = drawn.withColumn("__mix_c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__mix_n") - 1) / CHUNK))))
    copies = chunks.withColumn("__mix_copy", F.explode(F.sequence(
        F.col("__mix_c") * CHUNK + 1, F.least(F.col("__mix_n"), (F.col("__mix_c") + 1) * CHUNK))))
    order = F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                              F.col("__mix_copy").cast("string")))
    mixed = copies.withColumn("__mix_order", order).repartition(F.col("__mix_order")).sortWithinPartitions("__mix_order")
    out = list(docs.columns)
    cols = [F.col(f"`{c}`") for c in out if c != copy_col]
    if copy_col:
        cols.append(F.col("__mix_copy").alias(copy_col))
    return mixed.select(*cols)
