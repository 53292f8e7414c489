"""Registered queries of the numbered operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagstream.llm import bwt_dedup, deleted_interpolation, epsilon_grid, exact_dedup, feistel_pii, importance_resampling, lemp_negatives, markov_secrets, partenum_join, poisson_mix, quadtree_audit, spm_viterbi, zstd_lang
from tagstream.llm.common import table

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@query("op1_sentencepiece")
def op1_sentencepiece(spark, sf_dir):
    """Ids of every text by streaming Viterbi; ``restored``: they decode to the text."""
    return spm_viterbi.encode(table(spark, sf_dir, "documents"), TOKENIZER, verify=True)


PII_KEY = "tagstream-production-key"


@query("op3_feistel_pii")
def op3_feistel_pii(spark, sf_dir):
    """Every text with its personal data pseudonymised, and the finds per kind."""
    done = feistel_pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)

    def count(kind):
        return F.size(F.filter("pii", lambda f: f["kind"] == kind)).alias(f"n_{kind}")

    return done.select("doc_id", "text", *[count(k) for k in feistel_pii.KINDS])


MIX_SEED = 17
OP4_SQL = f"""
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
lam AS (SELECT source, 1.0 / (SELECT count(*) FROM n) * (SELECT sum(n) FROM n) / n AS lam FROM n),
rate AS (SELECT source, greatest(1, ceil(lam / 16.0))::BIGINT AS parts, lam / greatest(1, ceil(lam / 16.0)) AS mean
         FROM lam),
cdf AS (SELECT source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS c
        FROM rate, unnest(generate_series(0, ceil(mean + 12 * sqrt(mean) + 30)::BIGINT)) AS t(k)),
draw AS (SELECT d.doc_id, d.source, j,
           (('0x' || substr(md5('{MIX_SEED}|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT + 0.5)
           / 4503599627370496.0 AS u
         FROM documents d JOIN rate r ON d.source IS NOT DISTINCT FROM r.source,
              unnest(generate_series(1, r.parts)) AS t(j)),
cnt AS (SELECT doc_id, source, j, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draw.source
                                   AND cdf.c < draw.u) AS k FROM draw),
tot AS (SELECT doc_id, sum(k)::BIGINT AS k FROM cnt GROUP BY doc_id)
SELECT d.*, t.copy FROM documents d JOIN tot USING (doc_id), unnest(generate_series(1, tot.k)) AS t(copy)
"""


@query("op4_poisson_mix", OP4_SQL)
def op4_poisson_mix(spark, sf_dir):
    """Every source brought to an equal share: whole rows with their copy number, globally shuffled."""
    return poisson_mix.replicate(spark, table(spark, sf_dir, "documents"), seed=MIX_SEED)


OP6_SQL = r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
k AS (SELECT *, first_value(doc_id) OVER (PARTITION BY h ORDER BY points DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY h) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM k
"""


@query("op6_exact_dedup", OP6_SQL)
def op6_exact_dedup(spark, sf_dir):
    """Half of the documents as the snapshot, the other half as the batch that arrives; all rows decided."""
    return exact_dedup.exact_dedup(spark, *exact_dedup.split_batches(table(spark, sf_dir, "documents")))


@query("op2_importance_resampling")
def op2_importance_resampling(spark, sf_dir):
    """Log importance weight, Gumbel key and decision of every document."""
    return importance_resampling.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_zstd_language")
def op7_zstd_language(spark, sf_dir):
    """Language of every document; a fifth of the ids is held out from training."""
    docs = table(spark, sf_dir, "documents")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    dictionaries = zstd_lang.train(docs, fold != 0)
    found = zstd_lang.predict(docs, dictionaries)
    return found.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


@query("op8_markov_secrets")
def op8_markov_secrets(spark, sf_dir):
    """Secrets of every document: base patterns and what the Markov models add."""
    docs = table(spark, sf_dir, "documents")
    return markov_secrets.digest(markov_secrets.scan(docs, markov_secrets.train(docs)))


@query("op9_partenum_join")
def op9_partenum_join(spark, sf_dir):
    """Components of documents whose 3-word shingle sets have Jaccard similarity 0.9 or more."""
    return partenum_join.jaccard_components(spark, table(spark, sf_dir, "documents"), width=3, num=90, den=100)


@query("op10_epsilon_grid")
def op10_epsilon_grid(spark, sf_dir):
    """Components of equally labelled vectors with cosine 0.98 or more."""
    return epsilon_grid.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


@query("op5_bwt_dedup")
def op5_bwt_dedup(spark, sf_dir):
    """Bytes left of every document when repeated 100-byte strings go."""
    return bwt_dedup.digest(bwt_dedup.remove_repeats(spark, table(spark, sf_dir, "documents")))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
tok AS (SELECT r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
cell AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS df FROM tok GROUP BY ALL),
kept AS (SELECT lang, term, sum(n) AS ln FROM cell GROUP BY ALL HAVING sum(df) >= 3),
lg AS (SELECT lang, count(*) AS v, sum(ln) AS total FROM kept GROUP BY lang),
own AS (SELECT c.* FROM cell c SEMI JOIN kept k ON c.lang = k.lang AND c.term = k.term),
g AS (SELECT x.lang, x.source, coalesce(lg.v, 0) AS v, coalesce(o.n, 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN lg USING (lang)
           LEFT JOIN (SELECT lang, source, sum(n) AS n FROM own GROUP BY ALL) o USING (lang, source)),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS cnt,
             1 + (1000000000 * (coalesce(o.n, 0) + 1)::HUGEINT) // (g.n + g.v)::HUGEINT AS p,
             1 + (1000000000 * (k.ln + 1)::HUGEINT) // (lg.total + lg.v)::HUGEINT AS q
      FROM g JOIN kept k USING (lang) JOIN lg USING (lang)
           LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value FROM p WHERE cnt > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms)
QUALIFY part = 'pair' OR rank <= 200
"""


@query("op13_quadtree_audit", OP13_SQL)
def op13_quadtree_audit(spark, sf_dir):
    """Divergences of each source from the others of its language, and its leading terms."""
    return quadtree_audit.audit(spark, table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
QUALIFY rank <= 5
"""


@query("op11_lemp_negatives", OP11_SQL)
def op11_lemp_negatives(spark, sf_dir):
    """Five hard negatives for each of the five best positives of every hundredth vector."""
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))
    return lemp_negatives.mine(spark, vectors, F.col("vec_id") % 100 == 0)


@query("op12_deleted_interpolation")
def op12_deleted_interpolation(spark, sf_dir):
    """Log10 probability of every document under the bigram model; a seventh of the ids is held out."""
    crc = F.crc32(F.col("doc_id").cast("string"))
    return deleted_interpolation.score(spark, table(spark, sf_dir, "documents"), held_out=crc % 7 == 2, train=crc % 7 != 2,
                                       tune=F.floor(crc / 7) % 10 == 0)
