"""Registered queries: ad-hoc term parsing, priority union, filters, KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import adhoc as AD
from tidewatch.operators import scoring as SC
from tidewatch.plans import params
from tidewatch.plans.fixture_sql import SIGNALS, prepared_cte, with_ctes
from tidewatch.plans.q_scoring import _a1_sql, _a2_sql
from tidewatch.plans.registry import register
from tidewatch.sources import config as C
from tidewatch.sources import tables

SELECTED_TOPICS = ("click", "view")


def _turns(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "conversations")


_TERMS_SQL = """terms0 AS (
  SELECT conv_id, turn, pos - 1 AS pos, trim(raw) AS term FROM (
    SELECT conv_id, turn, unnest(parts) AS raw, unnest(range(1, len(parts) + 1)) AS pos
    FROM (SELECT conv_id, turn, string_split(replace(coalesce(text, ''), chr(10), ','), ',') AS parts
          FROM conversations))
  WHERE trim(raw) <> ''),
terms AS (
  SELECT conv_id, turn, min(pos) AS pos, arg_min(term, pos) AS term
  FROM terms0 GROUP BY conv_id, turn, lower(term))"""


@register("p29_parse_search_terms", "WITH " + _TERMS_SQL + """
SELECT conv_id, turn, CAST(pos AS BIGINT) AS pos, term FROM terms""")
def p29_parse_search_terms(spark, sf_dir):
    return AD.parse_search_terms(_turns(spark, sf_dir), "text", ["conv_id", "turn"])


def _saved_sql() -> str:
    rows = ", ".join(f"({i}, '{t[0]}')" for i, t in enumerate(params.FIXTURE_TOPICS))
    return f"saved(o, name) AS (VALUES {rows})"


@register("r5_search_then_saved_topics", "WITH " + _TERMS_SQL + ", " + _saved_sql() + """,
both_sides AS (
  SELECT term AS name, 0 AS p, conv_id AS a, turn AS b, pos AS c, 'search' AS origin FROM terms
  UNION ALL SELECT name, 1, o, 0, 0, 'saved' FROM saved)
SELECT arg_min(name, (p, a, b, c)) AS name, arg_min(origin, (p, a, b, c)) AS origin
FROM both_sides GROUP BY lower(name)""")
def r5_search_then_saved_topics(spark, sf_dir):
    search = AD.parse_search_terms(_turns(spark, sf_dir), "text", ["conv_id", "turn"]) \
        .select(F.col("term").alias("name"), F.col("conv_id").alias("a"), F.col("turn").alias("b"),
                F.col("pos").alias("c"))
    saved = C.topics_frame(spark, params.FIXTURE_TOPICS).select(
        "name", F.col("topic_ordinal").alias("a"), F.lit(0).cast("bigint").alias("b"),
        F.lit(0).alias("c"))
    return AD.union_first_wins(search, saved, "name", ("a", "b", "c"))


def _sel_sql() -> str:
    return "sel(topic) AS (VALUES " + ", ".join(f"('{t}')" for t in SELECTED_TOPICS) + ")"


@register("p30_p31_topic_filter", _a1_sql(with_ctes(SIGNALS, prepared_cte())) + ", " + _sel_sql() + """
SELECT topic, source, mention_count, round(trend_score, 6) AS trend_score
FROM source_summary WHERE topic IN (SELECT topic FROM sel)""")
def p30_p31_topic_filter(spark, sf_dir):
    sel = spark.createDataFrame([(t,) for t in SELECTED_TOPICS], "topic string")
    summary = SC.source_summary_one_pass(tables.signals(spark, sf_dir), dict(params.LEXICON),
                                         params.NEGATORS)
    return AD.filter_topics(summary, sel).select("topic", "source", "mention_count", "trend_score")


@register("a10_kpis", _a1_sql(with_ctes(SIGNALS, prepared_cte())) + _a2_sql() + """
SELECT arg_max(topic, (final_score_with_novelty, topic)) AS top_topic,
       CAST(sum(mention_count) AS BIGINT) AS total_mentions FROM final""")
def a10_kpis(spark, sf_dir):
    final = SC.topic_scores_from_records(tables.signals(spark, sf_dir), dict(params.LEXICON),
                                         params.NEGATORS)
    return AD.kpis(final)


@register("a11_value_counts_by_source", with_ctes(SIGNALS) + """
SELECT source, CAST(count(*) AS BIGINT) AS count FROM signals GROUP BY source""")
def a11_value_counts_by_source(spark, sf_dir):
    return AD.value_counts(tables.signals(spark, sf_dir), "source")


@register("a13_topic_list", with_ctes(SIGNALS) + """
SELECT DISTINCT topic FROM signals WHERE topic IS NOT NULL""")
def a13_topic_list(spark, sf_dir):
    return AD.topic_list(tables.signals(spark, sf_dir))
