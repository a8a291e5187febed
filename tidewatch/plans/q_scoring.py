"""Registered queries: cleaning, sentiment, normalisers, source and topic scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.text import clean_text
from tidewatch.operators import scoring
from tidewatch.operators.sentiment import lexicon_sentiment
from tidewatch.plans import params
from tidewatch.plans.fixture_sql import (MENTIONS, SIGNALS, clean, lexicon_cte, negators_cte,
                                         prepared_cte, sentiment_cte, with_ctes)
from tidewatch.plans.registry import register
from tidewatch.sources import tables


def prepared_signals(spark, sf_dir, scale: bool = True, about=()):
    return scoring.prepare_records(tables.signals(spark, sf_dir, about), lexicon=dict(params.LEXICON),
                                   negators=params.NEGATORS, scale=scale)


def prepared_mentions(spark, sf_dir):
    """Mentions carry no text: sentiment is 0 for every record."""
    m = tables.mentions(spark, sf_dir).withColumn("text", F.lit(""))
    return scoring.prepare_records(m)


# --- P1 / P1b ---------------------------------------------------------------

@register("p1_clean_text", with_ctes(SIGNALS) + f"""
SELECT source_item_id, {clean('text')} AS clean_text,
       CAST(CASE WHEN {clean('text')} = '' THEN 0
                 ELSE len(string_split({clean('text')}, ' ')) END AS BIGINT) AS n_tokens
FROM signals""")
def p1_clean_text(spark, sf_dir):
    s = tables.signals(spark, sf_dir).withColumn("clean_text", clean_text("text"))
    return s.select("source_item_id", "clean_text",
                    F.when(F.col("clean_text") == "", 0)
                    .otherwise(F.size(F.split("clean_text", " "))).alias("n_tokens"))


@register("p1b_clean_text_compact", with_ctes(SIGNALS) + f"""
SELECT source_item_id, {clean('text', '')} AS clean_text FROM signals""")
def p1b_clean_text_compact(spark, sf_dir):
    s = tables.signals(spark, sf_dir)
    return s.select("source_item_id", clean_text("text", punct="").alias("clean_text"))


# --- P3 ---------------------------------------------------------------------

@register("p3_lexicon_sentiment", with_ctes(SIGNALS, lexicon_cte(), negators_cte(),
                                            sentiment_cte()) + """
SELECT s.source_item_id, round(coalesce(se.sentiment, 0.0), 6) AS sentiment
FROM signals s LEFT JOIN sent se ON se.source_item_id = s.source_item_id""")
def p3_lexicon_sentiment(spark, sf_dir):
    s = tables.signals(spark, sf_dir)
    return s.select("source_item_id",
                    lexicon_sentiment(clean_text("text"), dict(params.LEXICON),
                                      params.NEGATORS).alias("sentiment"))


# --- N1 / N1b ---------------------------------------------------------------

@register("n1_source_max_scaling", with_ctes(SIGNALS) + """,
smax AS (SELECT source, max(engagement) AS m FROM signals GROUP BY source)
SELECT s.source_item_id, s.source,
       round(s.engagement / CASE WHEN smax.m = 0 THEN 1 ELSE smax.m END, 6) AS engagement_norm
FROM signals s LEFT JOIN smax ON smax.source = s.source""".replace("\n,", ","))
def n1_source_max_scaling(spark, sf_dir):
    s = tables.signals(spark, sf_dir)
    return scoring.scale_by_group_max(s).select("source_item_id", "source", "engagement_norm")


@register("n1b_global_max_scaling", with_ctes(MENTIONS) + """
SELECT event_id, round(engagement / (SELECT max(engagement) FROM mentions), 6) AS engagement_norm
FROM mentions""")
def n1b_global_max_scaling(spark, sf_dir):
    m = tables.mentions(spark, sf_dir)
    return scoring.scale_by_global_max(m).select("event_id", "engagement_norm")


# --- A1 / A2 ----------------------------------------------------------------

def _a1_sql(src_ctes: str) -> str:
    return src_ctes + """,
a1 AS (
  SELECT topic, source, CAST(count(*) AS BIGINT) AS mention_count,
         avg(engagement_norm) AS avg_engagement, sum(engagement) AS total_engagement_raw,
         avg(sentiment) AS avg_sentiment
  FROM prepared WHERE topic IS NOT NULL AND source IS NOT NULL GROUP BY topic, source),
a1s AS (
  SELECT *, mention_count / greatest((SELECT max(mention_count) FROM a1), 1) AS mention_score,
         avg_engagement / greatest((SELECT max(avg_engagement) FROM a1), 1e-9) AS engagement_score,
         (avg_sentiment + 1) / 2 AS sentiment_score
  FROM a1),
source_summary AS (
  SELECT *, 0.4 * mention_score + 0.4 * engagement_score + 0.2 * sentiment_score AS trend_score
  FROM a1s)"""


def _a2_sql(basis: str = "total_engagement") -> str:
    return """,
g AS (
  SELECT topic, CAST(sum(mention_count) AS BIGINT) AS mention_count,
         avg(avg_engagement) AS avg_engagement, sum(total_engagement_raw) AS total_engagement,
         avg(avg_sentiment) AS avg_sentiment, CAST(count(DISTINCT source) AS BIGINT) AS source_count
  FROM source_summary GROUP BY topic),
gs AS (
  SELECT *, mention_count / greatest((SELECT max(mention_count) FROM g), 1) AS mention_score,
         avg_engagement / greatest((SELECT max(avg_engagement) FROM g), 1e-9) AS engagement_score,
         (avg_sentiment + 1) / 2 AS sentiment_score
  FROM g),
gt AS (
  SELECT *, 0.4 * mention_score + 0.4 * engagement_score + 0.2 * sentiment_score AS trend_score,
         BASIS / greatest((SELECT sum(BASIS) FROM g), 1) AS p,
         1.0 / greatest((SELECT count(*) FROM g), 1) AS base
  FROM gs),
gn AS (SELECT *, p * ln((p + 1e-10) / (base + 1e-10)) AS novelty_score FROM gt),
gr AS (SELECT min(novelty_score) AS lo, max(novelty_score) AS hi FROM gn),
final_scores AS (
  SELECT gn.*, CASE WHEN gr.hi - gr.lo = 0 THEN 0.5
                    ELSE (novelty_score - gr.lo) / (gr.hi - gr.lo) END AS novelty_score_norm
  FROM gn, gr),
final AS (
  SELECT topic, mention_count, avg_engagement, total_engagement, avg_sentiment, source_count,
         mention_score, engagement_score, sentiment_score, trend_score, novelty_score,
         novelty_score_norm,
         0.30 * mention_score + 0.30 * engagement_score + 0.20 * sentiment_score
           + 0.20 * novelty_score_norm AS final_score_with_novelty,
         CASE WHEN trend_score >= 0.65 AND novelty_score_norm >= 0.5 THEN 'High trend / High novelty'
              WHEN trend_score >= 0.65 THEN 'High trend / Lower novelty'
              WHEN novelty_score_norm >= 0.5 THEN 'Emerging niche'
              ELSE 'Lower priority' END AS quadrant
  FROM final_scores)""".replace("BASIS", basis)


A1_COLS = ("topic, source, mention_count, round(avg_engagement, 6) AS avg_engagement, "
           "round(total_engagement_raw, 6) AS total_engagement_raw, "
           "round(avg_sentiment, 6) AS avg_sentiment, round(mention_score, 6) AS mention_score, "
           "round(engagement_score, 6) AS engagement_score, "
           "round(sentiment_score, 6) AS sentiment_score, round(trend_score, 6) AS trend_score")

A2_COLS = ("topic, mention_count, round(avg_engagement, 6) AS avg_engagement, "
           "round(total_engagement, 6) AS total_engagement, round(avg_sentiment, 6) AS avg_sentiment, "
           "source_count, round(mention_score, 6) AS mention_score, "
           "round(engagement_score, 6) AS engagement_score, "
           "round(sentiment_score, 6) AS sentiment_score, round(trend_score, 6) AS trend_score, "
           "round(novelty_score, 6) AS novelty_score, "
           "round(novelty_score_norm, 6) AS novelty_score_norm, "
           "round(final_score_with_novelty, 6) AS final_score_with_novelty, quadrant")

_SIGNALS_PREPARED = with_ctes(SIGNALS, prepared_cte())
_MENTIONS_PREPARED = with_ctes(MENTIONS) + """,
smax AS (SELECT source, max(engagement) AS m FROM mentions WHERE source IS NOT NULL GROUP BY source),
prepared AS (
  SELECT m.*, 0.0 AS sentiment,
         m.engagement / CASE WHEN smax.m = 0 THEN 1 ELSE smax.m END AS engagement_norm
  FROM mentions m LEFT JOIN smax ON smax.source = m.source)"""


@register("a1_source_summary", _a1_sql(_SIGNALS_PREPARED) + f"\nSELECT {A1_COLS} FROM source_summary")
def a1_source_summary(spark, sf_dir):
    return scoring.source_summary_one_pass(tables.signals(spark, sf_dir), dict(params.LEXICON),
                                           params.NEGATORS)


@register("a2_topic_scores", _a1_sql(_SIGNALS_PREPARED) + _a2_sql()
          + f"\nSELECT {A2_COLS} FROM final")
def a2_topic_scores(spark, sf_dir):
    """Flagship: signals -> clean/sentiment -> one-pass (topic, source) partials -> ranking."""
    return scoring.topic_scores_from_records(tables.signals(spark, sf_dir), dict(params.LEXICON),
                                             params.NEGATORS)


@register("a2_mentions_topic_scores", _a1_sql(_MENTIONS_PREPARED) + _a2_sql()
          + f"\nSELECT {A2_COLS} FROM final")
def a2_mentions_topic_scores(spark, sf_dir):
    """The same roll-up over all events (100k rows at sf0.1)."""
    m = tables.mentions(spark, sf_dir).withColumn("text", F.lit(""))
    return scoring.topic_scores_from_records(m)


@register("n5b_novelty_by_mentions", _a1_sql(_MENTIONS_PREPARED) + _a2_sql("mention_count")
          + f"\nSELECT {A2_COLS} FROM final")
def n5b_novelty_by_mentions(spark, sf_dir):
    """Notebook variant: novelty on the share of mention counts."""
    return scoring.topic_scores(scoring.source_summary(prepared_mentions(spark, sf_dir)),
                                novelty_basis="mention_count")
