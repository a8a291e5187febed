"""Keyword-axis profiles, scenario planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.keywords import occurrences
from tidewatch.plans import params

AXIS_TOKEN_RATE = 0.04


def _axes(axes):
    return axes or params.GENOME_AXES


def axis_hit_columns(clean_col: str = "clean_text", axes=None) -> dict:
    """Per-record additive columns: token count and keyword occurrences per axis."""
    ax = _axes(axes)
    c = F.coalesce(F.col(clean_col), F.lit(""))
    hits = occurrences(c, [kws for _, kws in ax])
    return {"_tokens": F.when(F.trim(c) == "", 0).otherwise(F.size(F.split(F.trim(c), " +"))),
            **{f"_h_{name}": F.get(hits, F.lit(i)) for i, (name, _) in enumerate(ax)}}


def axis_scores_from_sums(sums: DataFrame, axes=None) -> DataFrame:
    """Scores from per-topic sums of ``axis_hit_columns``."""
    ax = _axes(axes)
    denom = F.greatest(F.col("_tokens") * AXIS_TOKEN_RATE, F.lit(1.0))
    return sums.select("topic", *[F.least(F.lit(1.0), F.col(f"_h_{name}") / denom).alias(f"{name}_axis")
                                  for name, _ in ax])


def axis_scores(records: DataFrame, clean_col: str = "clean_text", axes=None) -> DataFrame:
    """Per topic, keyword occurrences per axis over the token count.

    Keywords contain no spaces, so occurrences are additive over records:
    counts are summed per topic and the topic text is never concatenated.
    """
    cols = axis_hit_columns(clean_col, axes)
    agg = (records.where(F.col("topic").isNotNull()).groupBy("topic")
           .agg(*[F.sum(col).alias(name) for name, col in cols.items()]))
    return axis_scores_from_sums(agg, axes)


def _clip01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def signature(score_cols, names) -> Column:
    """The two highest axes (ties in axis order), title-cased, ' + '."""
    entries = F.array(*[F.struct((-F.col(c)).alias("neg"), F.lit(i).alias("ord"),
                                 F.lit(n.title()).alias("name"))
                        for i, (c, n) in enumerate(zip(score_cols, names))])
    top = F.slice(F.array_sort(entries), 1, 2)
    return F.array_join(F.transform(top, lambda e: e["name"]), " + ")


def genome(axis: DataFrame, topic_summary: DataFrame, axes=None) -> DataFrame:
    """P16 (+ J3 inner join): axis scores blended with modality norms."""
    ax = _axes(axes)
    names = [n for n, _ in ax]
    j = axis.join(topic_summary.select("topic", "visual_innovation_norm", "audio_novelty_norm"),
                  "topic", "inner")
    cols = []
    for n in names:
        base = F.col(f"{n}_axis")
        if n == "innovation":
            v = _clip01(0.6 * base + 0.25 * F.coalesce("visual_innovation_norm", F.lit(0.0))
                        + 0.15 * F.coalesce("audio_novelty_norm", F.lit(0.0)))
        else:
            v = _clip01(base)
        cols.append(v.alias(f"{n}_score"))
    out = j.select("topic", *cols)
    return out.withColumn("genome_signature", signature([f"{n}_score" for n in names], names))



def scenario_plan(multimodal: DataFrame, genome_df: DataFrame, scenarios=None) -> DataFrame:
    """J4 + P18: every topic under every scenario.  The scenario weights are a
    fixed parameter embedded as a literal array that each topic row explodes
    (no join); axes missing for a topic count as 0."""
    names = [n for n, _ in params.GENOME_AXES]
    table = scenarios or params.SCENARIOS
    lit = F.array(*[F.struct(F.lit(name).alias("scenario"),
                             *[F.lit(float(w)).alias(f"w_{n}") for n, w in zip(names, ws)])
                    for name, ws in table])
    base = (multimodal.select("topic", "multimodal_final_score").join(genome_df, "topic", "left")
            .select("*", F.explode(lit).alias("_s")))
    impact = sum((F.coalesce(F.col(f"{n}_score"), F.lit(0.0)) * F.col(f"_s.w_{n}") for n in names),
                 F.lit(0.0))
    return base.select("topic", F.col("_s.scenario").alias("scenario"), impact.alias("impact_score"),
                       F.least(F.greatest(F.col("multimodal_final_score") + 0.25 * impact, F.lit(0.0)),
                               F.lit(1.5)).alias("adjusted_multimodal_score"))


def scenario_leaders(plan: DataFrame) -> DataFrame:
    """Top topic per scenario by adjusted score (ties -> topic)."""
    w = Window.partitionBy("scenario").orderBy(F.desc("adjusted_multimodal_score"), F.asc("topic"))
    return (plan.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
            .select("scenario", "topic", "adjusted_multimodal_score"))


def scenario_brief_lines(plan: DataFrame) -> DataFrame:
    """K5: markdown brief, one block per scenario in alphabetical order."""
    lead = scenario_leaders(plan)
    return lead.select("scenario", F.format_string(
        "## %s\nTop resilient topic: %s (adjusted score %.2f).\n", "scenario", "topic",
        "adjusted_multimodal_score").alias("block")).orderBy("scenario")


def pivot_scenarios(plan: DataFrame, topics: list[str]) -> DataFrame:
    """Scenario x topic matrix of adjusted scores (explicit topic list)."""
    return plan.groupBy("scenario").pivot("topic", topics).agg(F.first("adjusted_multimodal_score"))


def unpivot_genome(genome_df: DataFrame, axes=None) -> DataFrame:
    """(topic, dimension, score)."""
    names = [f"{n}_score" for n, _ in _axes(axes)]
    return genome_df.unpivot("topic", names, "dimension", "score")
