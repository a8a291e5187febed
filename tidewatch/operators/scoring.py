"""Record preparation and the two-level topic scoring.

Scale notes
-----------
* Per-record work is a projection (no shuffle).
* Per-source max (N1) is a partial/final aggregate joined back through a
  size-checked broadcast - never a window keyed by source, which would put a
  whole (possibly one-third-of-all-rows) source into one task.
* A1 is one hash aggregate with map-side combine; everything after it works on
  the (topic, source) table, whose size does not grow with the records.
* Global normalisers are one-row aggregates, cross-joined as a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.text import clean_text
from tidewatch.operators.joins import checked_broadcast, one_row

# Fixed weights and cut-offs of the scoring model.
TREND_WEIGHTS = (0.4, 0.4, 0.2)             # mention, engagement, sentiment
FINAL_WEIGHTS = (0.30, 0.30, 0.20, 0.20)    # mention, engagement, sentiment, novelty
TREND_CUTOFF = 0.65
NOVELTY_CUTOFF = 0.50
QUADRANTS = ("High trend / High novelty", "High trend / Lower novelty",
             "Emerging niche", "Lower priority")
EPS_KL = 1e-10


def coerce_records(df: DataFrame) -> DataFrame:
    """Date -> DATE or null, engagement -> double or 0, text null -> ''."""
    out = df
    if "date" in df.columns:
        dtype = dict(df.dtypes)["date"]
        if dtype not in ("date",):
            out = out.withColumn("date", F.expr("try_to_date(substring(cast(date AS string), 1, 10))"))
    out = out.withColumn(
        "engagement",
        F.coalesce(F.expr("try_cast(engagement AS double)"), F.lit(0.0)))
    return out.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))


def scale_by_group_max(df: DataFrame, group: str = "source", value: str = "engagement",
                       out: str = "engagement_norm") -> DataFrame:
    """Value / max(value) within the group, a max of exactly 0 -> 1.

    Rows with a null group get null, as a grouped transform would.
    """
    maxes = (df.where(F.col(group).isNotNull())
             .groupBy(group).agg(F.max(value).alias("_group_max")))
    joined = df.join(checked_broadcast(maxes), on=group, how="left")
    denom = F.when(F.col("_group_max") == 0, F.lit(1.0)).otherwise(F.col("_group_max"))
    return joined.withColumn(out, F.col(value) / denom).drop("_group_max")


def scale_by_global_max(df: DataFrame, value: str = "engagement",
                        out: str = "engagement_norm") -> DataFrame:
    """Value / global max (notebook variant)."""
    m = df.agg(F.max(value).alias("_global_max"))
    return (df.crossJoin(one_row(m))
            .withColumn(out, F.col(value) / F.col("_global_max")).drop("_global_max"))


def prepare_records(df: DataFrame, lexicon=None, negators=None, punct: str = " ", scale: bool = True) -> DataFrame:
    """P2 + P1 + P3 + N1: adds clean_text, sentiment, engagement_norm.

    The source maximum needs a pass of its own over the records; callers that
    do not use engagement_norm leave it out with ``scale=False``."""
    from tidewatch.operators.sentiment import lexicon_sentiment

    out = coerce_records(df).withColumn("clean_text", clean_text("text", punct))
    if lexicon is None:
        out = out.withColumn("sentiment", F.lit(0.0))
    else:
        out = out.withColumn("sentiment", lexicon_sentiment(F.col("clean_text"), lexicon, negators))
    return scale_by_group_max(out) if scale else out


def _blend(*pairs: tuple[float, Column]) -> Column:
    total = None
    for w, c in pairs:
        term = F.lit(w) * c
        total = term if total is None else total + term
    return total


def _ratio_to_max(col: str, max_col: str, floor: float) -> Column:
    return F.col(col) / F.greatest(F.col(max_col), F.lit(floor))


def source_summary(prepared: DataFrame) -> DataFrame:
    """A1: per (topic, source) counts and means, then global ratio-to-max scores."""
    g = (prepared.where(F.col("topic").isNotNull() & F.col("source").isNotNull())
         .groupBy("topic", "source")
         .agg(F.count(F.lit(1)).alias("mention_count"),
              F.avg("engagement_norm").alias("avg_engagement"),
              F.sum("engagement").alias("total_engagement_raw"),
              F.avg("sentiment").alias("avg_sentiment"))).checkpoint()
    # the (topic, source) table is small: checkpointed once so the global
    # normalisers below never re-run the record scan
    m = g.agg(F.max("mention_count").alias("_max_count"),
              F.max("avg_engagement").alias("_max_eng"))
    wm, we, ws = TREND_WEIGHTS
    return (g.crossJoin(one_row(m))
            .withColumn("mention_score", _ratio_to_max("mention_count", "_max_count", 1.0))
            .withColumn("engagement_score", _ratio_to_max("avg_engagement", "_max_eng", 1e-9))
            .withColumn("sentiment_score", (F.col("avg_sentiment") + 1.0) / 2.0)
            .withColumn("trend_score", _blend((wm, F.col("mention_score")),
                                              (we, F.col("engagement_score")),
                                              (ws, F.col("sentiment_score"))))
            .drop("_max_count", "_max_eng"))


def summary_partials(records: DataFrame) -> DataFrame:
    """Mergeable (topic, source) partials: count, engagement sum and max,
    sentiment sum.  Partials of disjoint record sets combine with
    ``merge_partials``; ``source_summary_from_partials`` then equals
    ``source_summary(prepare_records(all records))``."""
    sent = F.col("sentiment") if "sentiment" in records.columns else F.lit(0.0)
    eng = F.coalesce(F.expr("try_cast(engagement AS double)"), F.lit(0.0))
    return (records.where(F.col("topic").isNotNull() & F.col("source").isNotNull())
            .groupBy("topic", "source")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(eng).alias("sum_engagement"),
                 F.max(eng).alias("max_engagement"), F.sum(sent).alias("sum_sentiment")))


def merge_partials(*parts: DataFrame) -> DataFrame:
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("topic", "source").agg(
        F.sum("n").alias("n"), F.sum("sum_engagement").alias("sum_engagement"),
        F.max("max_engagement").alias("max_engagement"), F.sum("sum_sentiment").alias("sum_sentiment"))


def source_summary_from_partials(parts: DataFrame) -> DataFrame:
    """A1 from partials: scaling by the source max is linear, so the mean of
    scaled engagement is the mean engagement over the source max."""
    smax = parts.groupBy("source").agg(F.max("max_engagement").alias("_smax"))
    denom = F.when(F.col("_smax") == 0, F.lit(1.0)).otherwise(F.col("_smax"))
    g = (parts.join(smax, "source")
         .select("topic", "source", F.col("n").alias("mention_count"),
                 (F.col("sum_engagement") / F.col("n") / denom).alias("avg_engagement"),
                 F.col("sum_engagement").alias("total_engagement_raw"),
                 (F.col("sum_sentiment") / F.col("n")).alias("avg_sentiment"))).checkpoint()
    m = g.agg(F.max("mention_count").alias("_max_count"), F.max("avg_engagement").alias("_max_eng"))
    wm, we, ws = TREND_WEIGHTS
    return (g.crossJoin(one_row(m))
            .withColumn("mention_score", _ratio_to_max("mention_count", "_max_count", 1.0))
            .withColumn("engagement_score", _ratio_to_max("avg_engagement", "_max_eng", 1e-9))
            .withColumn("sentiment_score", (F.col("avg_sentiment") + 1.0) / 2.0)
            .withColumn("trend_score", _blend((wm, F.col("mention_score")),
                                              (we, F.col("engagement_score")),
                                              (ws, F.col("sentiment_score"))))
            .drop("_max_count", "_max_eng"))


def minmax(col: str | Column, lo: str, hi: str) -> Column:
    """N3/N4 body: (x - min) / (max - min); a zero range gives 0.5."""
    c = F.col(col) if isinstance(col, str) else col
    rng = F.col(hi) - F.col(lo)
    return F.when(rng == 0, F.lit(0.5)).otherwise((c - F.col(lo)) / rng)


def novelty(df: DataFrame, basis: str = "total_engagement", out: str = "novelty_score") -> DataFrame:
    """Pointwise KL term of each topic's share against a uniform baseline."""
    tot = df.agg(F.sum(basis).alias("_basis_sum"), F.count(F.lit(1)).alias("_n_topics"))
    p = F.col(basis) / F.greatest(F.col("_basis_sum"), F.lit(1.0))
    base = F.lit(1.0) / F.greatest(F.col("_n_topics"), F.lit(1)).cast("double")
    return (df.crossJoin(one_row(tot))
            .withColumn(out, p * F.log((p + EPS_KL) / (base + EPS_KL)))
            .drop("_basis_sum", "_n_topics"))


def with_minmax(df: DataFrame, col: str, out: str) -> DataFrame:
    """N3/N4 as a frame operator: nulls -> 0, then min-max over all rows."""
    filled = df.withColumn(out, F.coalesce(F.col(col).cast("double"), F.lit(0.0)))
    rng = filled.agg(F.min(out).alias("_lo"), F.max(out).alias("_hi"))
    return (filled.crossJoin(one_row(rng))
            .withColumn(out, minmax(out, "_lo", "_hi")).drop("_lo", "_hi"))


def quadrant(trend: str = "trend_score", novelty_norm: str = "novelty_score_norm") -> Column:
    """P6."""
    t = F.col(trend) >= TREND_CUTOFF
    n = F.col(novelty_norm) >= NOVELTY_CUTOFF
    return (F.when(t & n, QUADRANTS[0]).when(t, QUADRANTS[1])
            .when(n, QUADRANTS[2]).otherwise(QUADRANTS[3]))


def topic_scores(summary: DataFrame, novelty_basis: str = "total_engagement") -> DataFrame:
    """A2: roll the (topic, source) table up to topics.

    ``avg_engagement`` and ``avg_sentiment`` are unweighted means of the source
    means.  Output is ordered by final score (ties by topic).
    """
    g = (summary.groupBy("topic")
         .agg(F.sum("mention_count").alias("mention_count"),
              F.avg("avg_engagement").alias("avg_engagement"),
              F.sum("total_engagement_raw").alias("total_engagement"),
              F.avg("avg_sentiment").alias("avg_sentiment"),
              F.count_distinct("source").alias("source_count"))).checkpoint()
    m = g.agg(F.max("mention_count").alias("_max_count"),
              F.max("avg_engagement").alias("_max_eng"))
    wm, we, ws = TREND_WEIGHTS
    scored = (g.crossJoin(one_row(m))
              .withColumn("mention_score", _ratio_to_max("mention_count", "_max_count", 1.0))
              .withColumn("engagement_score", _ratio_to_max("avg_engagement", "_max_eng", 1e-9))
              .withColumn("sentiment_score", (F.col("avg_sentiment") + 1.0) / 2.0)
              .withColumn("trend_score", _blend((wm, F.col("mention_score")),
                                                (we, F.col("engagement_score")),
                                                (ws, F.col("sentiment_score"))))
              .drop("_max_count", "_max_eng"))
    scored = novelty(scored, basis=novelty_basis)
    scored = with_minmax(scored, "novelty_score", "novelty_score_norm")
    fm, fe, fs, fn = FINAL_WEIGHTS
    return (scored
            .withColumn("final_score_with_novelty",
                        _blend((fm, F.col("mention_score")), (fe, F.col("engagement_score")),
                               (fs, F.col("sentiment_score")), (fn, F.col("novelty_score_norm"))))
            .withColumn("quadrant", quadrant())
            .orderBy(F.desc("final_score_with_novelty"), F.asc("topic")))


def source_summary_one_pass(records: DataFrame, lexicon=None, negators=None,
                            punct: str = " ") -> DataFrame:
    """A1 in a single pass over the records.

    Scaling by the per-source max is linear, so the mean scaled engagement of a
    (topic, source) group is its mean engagement over the source max: the
    records are aggregated once into mergeable partials and the source max is
    applied on that small table.  No second scan, no record-level join-back.
    """
    from tidewatch.operators.sentiment import lexicon_sentiment

    out = coerce_records(records)
    if lexicon is None:
        out = out.withColumn("sentiment", F.lit(0.0))
    else:
        out = out.withColumn("sentiment", lexicon_sentiment(clean_text("text", punct), lexicon, negators))
    return source_summary_from_partials(summary_partials(out))


def topic_scores_from_records(records: DataFrame, lexicon=None, negators=None) -> DataFrame:
    """Flagship: records -> one-pass (topic, source) summary -> topic ranking."""
    return topic_scores(source_summary_one_pass(records, lexicon, negators))
