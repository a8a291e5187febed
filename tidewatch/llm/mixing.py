"""Mixing sources to target weights (operator 4).

Method: Poisson replication.  A source's repetition rate is its target share
over its actual share; each document's uniform number (a hash of seed and
doc_id) goes through the inverse Poisson distribution with that mean, the
document is exploded by the count, and all copies are shuffled globally by
the hash of (seed, doc_id, copy).

* Shares are by characters, counted over all documents with map-side combine;
  the result is one row per source.
* Rates join back to the documents by source.  A source with a third of all
  rows is only a join key of a small table there: its side is broadcast by the
  planner's size check or split by the skew join.
* A copy count depends on (seed, doc_id, rate) alone, so a lost executor
  recomputes the same copies, whatever the partitioning.
* The shuffle deals copies out by their hash key and sorts inside partitions:
  each output partition is a random part of the mixture in random order.

Rates are as high as the targets ask, so that a source reaches its share
however small it is; ``max_rate`` is an opt-in that bounds the copies of a
document (what a source loses by it goes to no other).  Null or empty texts weigh nothing but follow their source's
rate; a null source is a source; without ``weights`` every source gets the
same target; weights of absent sources are spread over the others; a source
with weight 0 goes; a source without any characters keeps rate 1; repeated rows are
replicated alike; null doc_ids hash as such; empty table, empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.store import Scratch

SEED = "mix-1"
EPOCHS = 1.0
TERMS = 64     # of the distribution function, more for high rates
LEAST_TERM = 1e-17   # smaller ones above the mean are beyond the 52 bits of the uniform number
DIRECT = 500.0       # terms of higher rates go by logarithms, as exp(-rate) comes near 0


def uniform(*parts) -> Column:
    """A number in [0, 1) from the md5 of the parts (52 bits)."""
    key = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(str(p))
                             for p in parts])
    return F.conv(F.substr(F.md5(key.cast("binary")), F.lit(1), F.lit(13)), 16, 10).cast("double") / float(1 << 52)


def poisson_count(u: Column, rate: Column) -> Column:
    """Inverse of the Poisson distribution function: the number of k with
    P(X <= k) <= u."""
    start = F.struct(F.lit(0).alias("n"), (-rate).alias("log"), F.exp(-rate).alias("term"), F.exp(-rate).alias("cdf"))
    # ten standard deviations above the mean
    last = F.greatest(F.lit(TERMS), F.ceil(rate + 10 * F.sqrt(rate) + 34).cast("int"))

    def step(a: Column, k: Column) -> Column:
        more = (a["cdf"] <= u) & ((a["term"] > LEAST_TERM) | (k <= rate))
        log = F.when(rate > DIRECT, a["log"] + F.log(rate / k)).otherwise(a["log"])
        term = F.when(rate > DIRECT, F.exp(log)).otherwise(a["term"] * rate / k)
        return F.struct((a["n"] + F.when(more, 1).otherwise(0)).alias("n"), log.alias("log"), term.alias("term"),
                        (a["cdf"] + term).alias("cdf"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["n"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS,
                 max_rate: float | None = None) -> DataFrame:
    """(source, n_docs, chars, rate) per source."""
    size = F.coalesce(F.length(F.col("text").cast("string")), F.lit(0)).cast("bigint")
    sums = Scratch(docs.sparkSession, "mixing").keep(
        docs.select(F.col("source").alias("source"), size.alias("n")).groupBy("source").agg(
            F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("chars")), "sources")
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    # the weight of sources without text does not count
    sums = sums.withColumn("weight", F.when(F.col("chars") > 0, weight).otherwise(F.lit(0.0)))
    total = sums.agg(F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight"))
    rate = F.col("weight") / F.col("all_weight") * F.col("all_chars") * F.lit(epochs) / F.col("chars")
    rate = F.coalesce(rate, F.lit(1.0))
    if max_rate is not None:
        rate = F.least(rate, F.lit(float(max_rate)))
    return sums.join(F.broadcast(total)).select(   # one row
        "source", "n_docs", "chars", F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(rate).alias("rate"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = EPOCHS,
                seed: str = SEED, max_rate: float | None = None) -> DataFrame:
    """The mixture: the columns of ``docs`` plus ``copy`` (0, 1, ...) and
    ``mix_key``, in global random order."""
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("copy", "mix_key")]
    rates = source_rates(docs, weights, epochs, max_rate).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    counted = (docs.select(*own).join(rates, F.col("source").eqNullSafe(F.col("__source")))
               .withColumn("__n", poisson_count(uniform(seed, F.col("doc_id")), F.col("__rate")))
               .where(F.col("__n") > 0))
    copies = counted.select(*own, F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("copy"))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws(
        ":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.col("copy").cast("string")).cast("binary")))
    return keyed.repartition("mix_key").sortWithinPartitions("mix_key")


MIX_SQL = """
WITH s AS (
  SELECT source, sum(coalesce(length(text), 0)) AS chars FROM {docs} GROUP BY source),
w AS (SELECT source, chars, CASE WHEN chars > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM s),
r AS (
  SELECT source, CASE WHEN chars = 0 THEN 1.0::DOUBLE
    ELSE weight / sum(weight) OVER () * sum(chars) OVER ()::DOUBLE * 1.0::DOUBLE / chars::DOUBLE END AS rate
  FROM w),
t AS (
  SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS term
  FROM (SELECT source, rate, unnest(range(0, greatest(64, ceil(rate + 10 * sqrt(rate) + 34)::BIGINT))) AS k FROM r)),
c AS (SELECT *, sum(term) OVER (PARTITION BY source ORDER BY k) AS cdf FROM t),
f AS (SELECT source, list(cdf ORDER BY k) FILTER (term > 1e-17 OR k + 1 <= rate) AS cdfs FROM c GROUP BY source),
d AS (
  SELECT docs.*, f.cdfs,
    ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '~')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM {docs} AS docs JOIN f ON docs.source IS NOT DISTINCT FROM f.source),
n AS (SELECT *, len(list_filter(cdfs, lambda x: x <= u))::INTEGER AS n FROM d)
SELECT doc_id, text, lang, source, n_chars, copy, md5('mix-1:' || coalesce(doc_id::VARCHAR, '~') || ':' || copy) AS mix_key
FROM (SELECT *, unnest(range(0, n))::INTEGER AS copy FROM n)
"""
