"""Registered queries: topic fusion, scenarios and explanations with SQL forms.

The full chain feeds these operators from a fitted model, which SQL cannot
repeat.  Here the same operators run on topic-level inputs that are plain
aggregates of the whole ``lineitem`` table (a topic per supplier), so every
value can be checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import explain as E
from tidewatch.operators import fusion as FU
from tidewatch.operators import strategy as ST
from tidewatch.plans import params
from tidewatch.plans.registry import register
from tidewatch.sources import tables

_AXES = [n for n, _ in params.GENOME_AXES]
# inputs per topic: (column, Spark SQL and DuckDB expression over lineitem)
_FINAL = (("trend_score", "avg(l_discount) * 8"), ("novelty_score_norm", "avg(l_tax) * 9"),
          ("source_count", "count(DISTINCT l_shipdate) % 4"), ("avg_sentiment", "avg(l_discount) - 0.05"))
_MODAL = (("visual_energy", "avg(l_quantity)"), ("visual_innovation", "avg(l_extendedprice)"),
          ("audio_energy_score", "sum(l_tax)"), ("audio_novelty_signal", "sum(l_discount)"))
_NODES = (("weighted_degree", "count(*) * 0.01"), ("pagerank", "avg(l_linenumber) * 0.1"), ("betweenness", "min(l_tax)"))
_FORECAST = (("forecast_growth_score", "avg(l_quantity) / 50"), ("forecast_confidence", "avg(l_linenumber) / 7"))
_DEEP = (("deep_fusion_score", "avg(l_tax) * 10"),)
_AXIS = tuple((f"{n}_axis", f"avg(l_quantity + {i} * l_linenumber) / {30 + 9 * i}") for i, n in enumerate(_AXES))


def _inputs(spark, sf_dir, columns, keep: str = "true"):
    return (tables.read_table(spark, sf_dir, "lineitem").where(keep)
            .groupBy(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("topic"))
            .agg(*[F.expr(e).alias(c) for c, e in columns]))


def _multimodal(spark, sf_dir):
    """Topics of some inputs are missing: their scores get the defaults."""
    return FU.multimodal_summary(
        _inputs(spark, sf_dir, _FINAL), _inputs(spark, sf_dir, _MODAL, "l_suppkey % 5 <> 0"),
        _inputs(spark, sf_dir, _NODES, "l_suppkey % 3 <> 0"), _inputs(spark, sf_dir, _FORECAST, "l_suppkey % 4 <> 0"),
        _inputs(spark, sf_dir, _DEEP, "l_suppkey % 7 <> 0"))


def _genome(spark, sf_dir, multimodal):
    return ST.genome(_inputs(spark, sf_dir, _AXIS, "l_suppkey % 6 <> 0"), multimodal)


def _cte(name: str, columns, keep: str = "true") -> str:
    return (f"{name} AS (SELECT 's' || l_suppkey AS topic, " + ", ".join(f"{e} AS {c}" for c, e in columns)
            + f" FROM lineitem WHERE {keep} GROUP BY l_suppkey)")


_NORMS = (("visual_energy", "visual_energy_norm"), ("visual_innovation", "visual_innovation_norm"),
          ("audio_energy_score", "audio_energy_norm"), ("audio_novelty_signal", "audio_novelty_norm"),
          ("centrality", "network_centrality_norm"))
_ALIGN = "(trend_score + visual_energy_norm + audio_energy_norm) / 3"
_MM_SQL = "WITH " + ", ".join([
    _cte("f", _FINAL), _cte("mo", _MODAL, "l_suppkey % 5 <> 0"), _cte("no", _NODES, "l_suppkey % 3 <> 0"),
    _cte("fc", _FORECAST, "l_suppkey % 4 <> 0"), _cte("de", _DEEP, "l_suppkey % 7 <> 0"),
    """j AS (SELECT f.*, coalesce(visual_energy, 0) AS visual_energy, coalesce(visual_innovation, 0) AS visual_innovation,
      coalesce(audio_energy_score, 0) AS audio_energy_score, coalesce(audio_novelty_signal, 0) AS audio_novelty_signal,
      coalesce(weighted_degree, 0) + coalesce(pagerank, 0) + coalesce(betweenness, 0) AS centrality,
      coalesce(forecast_growth_score, 0.5) AS forecast_growth_score, coalesce(forecast_confidence, 0.5) AS forecast_confidence,
      coalesce(deep_fusion_score, 0.5) AS deep_fusion_score
    FROM f LEFT JOIN mo USING (topic) LEFT JOIN no USING (topic) LEFT JOIN fc USING (topic) LEFT JOIN de USING (topic))""",
    "n AS (SELECT *, " + ", ".join(
        f"CASE WHEN max({s}) OVER () = min({s}) OVER () THEN 0.5 "
        f"ELSE ({s} - min({s}) OVER ()) / (max({s}) OVER () - min({s}) OVER ()) END AS {o}" for s, o in _NORMS) + " FROM j)",
    f"""al AS (SELECT *, least(greatest(1 - sqrt((pow(trend_score - {_ALIGN}, 2) + pow(visual_energy_norm - {_ALIGN}, 2)
      + pow(audio_energy_norm - {_ALIGN}, 2)) / 2), 0), 1) AS cross_modal_alignment FROM n)""",
    "sc AS (SELECT *, " + " + ".join(f"{w} * {c}" for c, w in FU.MULTIMODAL_WEIGHTS) + " AS multimodal_final_score FROM al)",
    "mm AS (SELECT *, dense_rank() OVER (ORDER BY multimodal_final_score DESC) AS multimodal_rank FROM sc)"])

_GENOME_SQL = _MM_SQL + ", " + _cte("ax", _AXIS, "l_suppkey % 6 <> 0") + """,
ge AS (SELECT topic, least(greatest(0.6 * innovation_axis + 0.25 * visual_innovation_norm + 0.15 * audio_novelty_norm, 0), 1)
  AS innovation_score, """ + ", ".join(f"least(greatest({n}_axis, 0), 1) AS {n}_score" for n in _AXES[1:]) + """
  FROM ax JOIN mm USING (topic))"""

_PLAN_SQL = _GENOME_SQL + ", s(scenario, " + ", ".join(f"w_{n}" for n in _AXES) + ") AS (VALUES " + ", ".join(
    f"('{name}', " + ", ".join(str(w) for w in ws) + ")" for name, ws in params.SCENARIOS) + """),
im AS (SELECT mm.topic, scenario, multimodal_final_score AS m, """ + " + ".join(
    f"coalesce({n}_score, 0) * w_{n}" for n in _AXES) + """ AS impact_score FROM mm CROSS JOIN s LEFT JOIN ge USING (topic)),
pl AS (SELECT topic, scenario, impact_score, least(greatest(m + 0.25 * impact_score, 0), 1.5) AS adjusted_multimodal_score FROM im),
le AS (SELECT scenario, topic, adjusted_multimodal_score FROM (SELECT *, row_number() OVER (
  PARTITION BY scenario ORDER BY adjusted_multimodal_score DESC, topic) AS rn FROM pl) WHERE rn = 1)"""

_DRIVERS = ", ".join(f"{{'neg': -coalesce({c}, 0), 'ord': {i}, 'name': '{c}'}}" for i, c in enumerate(E.COMPONENTS))
_RISK = "concat_ws(', ', " + ", ".join(f"CASE WHEN coalesce({c}, 0) < {t} THEN '{label}' END" for c, t, label in E.RISKS) + ")"
_EXPLAIN_SQL = _MM_SQL + f""",
dr AS (SELECT topic, list_transform(list_slice(list_sort([{_DRIVERS}]), 1, 3), lambda e: e.name) AS d, {_RISK} AS r,
  multimodal_final_score AS m, forecast_confidence AS c FROM mm),
ex AS (SELECT topic, d[1] AS top_driver_1, d[2] AS top_driver_2, d[3] AS top_driver_3,
  CASE WHEN r = '' THEN 'none' ELSE r END AS risk_flags,
  topic || ' ranks with strong support from ' || array_to_string(list_transform(d, lambda x: replace(x, '_', ' ')), ', ')
  || '. Its fused score is ' || format('{{:.2f}}', m) || ', with forecast confidence at ' || format('{{:.2f}}', c)
  || CASE WHEN r = '' THEN '' ELSE '; risks: ' || r END || '.' AS explanation FROM dr)"""

_MM_OUT = [c for _, c in _NORMS] + ["forecast_growth_score", "forecast_confidence", "deep_fusion_score",
                                    "cross_modal_alignment", "multimodal_final_score"]


@register("j1_topic_fusion", _MM_SQL + "\nSELECT topic, " + ", ".join(f"round({c}, 6) AS {c}" for c in _MM_OUT)
          + ", CAST(multimodal_rank AS DOUBLE) AS multimodal_rank FROM mm")
def j1_topic_fusion(spark, sf_dir):
    """J1, N3, N6, P24-P26, W6."""
    return _multimodal(spark, sf_dir).select("topic", *_MM_OUT, "multimodal_rank")


@register("j4_p18_scenario_plan", _PLAN_SQL + """
SELECT topic, scenario, round(impact_score, 6) AS impact_score,
  round(adjusted_multimodal_score, 6) AS adjusted_multimodal_score FROM pl""")
def j4_p18_scenario_plan(spark, sf_dir):
    m = _multimodal(spark, sf_dir)
    return ST.scenario_plan(m, _genome(spark, sf_dir, m))


@register("w9_scenario_leaders_sql", _PLAN_SQL + """
SELECT scenario, topic, round(adjusted_multimodal_score, 6) AS adjusted_multimodal_score FROM le""")
def w9_scenario_leaders_sql(spark, sf_dir):
    return ST.scenario_leaders(j4_p18_scenario_plan(spark, sf_dir))


@register("k5_scenario_brief_sql", _PLAN_SQL + """
SELECT scenario, '## ' || scenario || chr(10) || 'Top resilient topic: ' || topic || ' (adjusted score '
  || format('{:.2f}', adjusted_multimodal_score) || ').' || chr(10) AS block FROM le""")
def k5_scenario_brief_sql(spark, sf_dir):
    m = _multimodal(spark, sf_dir)
    return ST.scenario_brief_lines(ST.scenario_plan(m, _genome(spark, sf_dir, m)))


_PIVOT = ["s1", "s2", "s3"]


@register("r8_scenario_pivot_sql", _PLAN_SQL + "\nSELECT scenario, " + ", ".join(
    f"round(max(adjusted_multimodal_score) FILTER (topic = '{t}'), 6) AS {t}" for t in _PIVOT) + " FROM pl GROUP BY scenario")
def r8_scenario_pivot_sql(spark, sf_dir):
    return ST.pivot_scenarios(j4_p18_scenario_plan(spark, sf_dir), _PIVOT)


@register("p19_p21_explanations", _EXPLAIN_SQL + "\nSELECT * FROM ex")
def p19_p21_explanations(spark, sf_dir):
    return E.explainability(_multimodal(spark, sf_dir))


@register("k4_report_blocks", _EXPLAIN_SQL + """
SELECT topic, '## ' || topic || chr(10) || explanation || chr(10) AS block FROM ex""")
def k4_report_blocks(spark, sf_dir):
    return E.report_blocks(E.explainability(_multimodal(spark, sf_dir)))
