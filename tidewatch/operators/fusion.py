"""Learned and weighted fusion.

M1 trains a Spark ML pipeline on all records (distributed fit); everything
else is on topic-level tables whose size is bounded by the number of topics.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.joins import checked_broadcast, one_row
from tidewatch.operators.scoring import minmax

NUMERIC_FEATURES = ("sentiment", "engagement_norm", "visual_brightness", "visual_colorfulness",
                    "visual_edge_density", "visual_energy", "visual_innovation",
                    "audio_energy_score", "audio_novelty_signal", "audio_tempo_norm",
                    "audio_genre_confidence")
CATEGORICAL_FEATURES = ("source", "topic", "audio_genre_label")
TARGET_WEIGHTS = (0.55, 0.25, 0.20)  # engagement_norm, sentiment score, topic mean engagement
SCORE_CLIP = (0.0, 1.5)

MULTIMODAL_WEIGHTS = (
    ("trend_score", 0.22), ("novelty_score_norm", 0.12), ("visual_energy_norm", 0.10),
    ("visual_innovation_norm", 0.08), ("audio_energy_norm", 0.11), ("audio_novelty_norm", 0.07),
    ("network_centrality_norm", 0.07), ("forecast_growth_score", 0.08),
    ("deep_fusion_score", 0.10), ("cross_modal_alignment", 0.05))


def fusion_target(records: DataFrame) -> DataFrame:
    """P22 (+ J9): the per-record training target."""
    eng = F.coalesce(F.col("engagement_norm").cast("double"), F.lit(0.0))
    sent = F.coalesce(F.col("sentiment").cast("double"), F.lit(0.0))
    means = (records.where(F.col("topic").isNotNull()).groupBy("topic")
             .agg(F.avg("engagement_norm").alias("_topic_mean")))
    w1, w2, w3 = TARGET_WEIGHTS
    return (records.join(checked_broadcast(means), "topic", "left")
            .withColumn("fusion_target", w1 * eng + w2 * ((sent + 1.0) / 2.0)
                        + w3 * F.coalesce(F.col("_topic_mean"), F.lit(0.0)))
            .drop("_topic_mean"))


def fill_features(records: DataFrame) -> tuple[DataFrame, list[str], list[str]]:
    """Numeric -> 0.0, categorical -> 'unknown', only columns present."""
    num = [c for c in NUMERIC_FEATURES if c in records.columns]
    cat = [c for c in CATEGORICAL_FEATURES if c in records.columns]
    out = records
    for c in num:
        out = out.withColumn(f"_f_{c}", F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
    for c in cat:
        out = out.withColumn(f"_f_{c}", F.coalesce(F.col(c).cast("string"), F.lit("unknown")))
    return out, num, cat


def deep_fusion(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """M1: fit a regression pipeline on the target and score the same records.

    Returns (scored records, topic scores A8).
    """
    prepared, num, cat = fill_features(fusion_target(records))
    stages = []
    for c in cat:
        stages.append(StringIndexer(inputCol=f"_f_{c}", outputCol=f"_i_{c}", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
    if cat:
        stages.append(OneHotEncoder(inputCols=[f"_i_{c}" for c in cat],
                                    outputCols=[f"_o_{c}" for c in cat], handleInvalid="keep",
                                    dropLast=False))
    stages.append(VectorAssembler(inputCols=[f"_f_{c}" for c in num], outputCol="_num",
                                  handleInvalid="keep"))
    stages.append(StandardScaler(inputCol="_num", outputCol="_num_scaled", withMean=True, withStd=True))
    stages.append(VectorAssembler(inputCols=["_num_scaled"] + [f"_o_{c}" for c in cat],
                                  outputCol="_features"))
    stages.append(LinearRegression(featuresCol="_features", labelCol="fusion_target",
                                   predictionCol="_pred", regParam=1e-6, elasticNetParam=0.0,
                                   maxIter=100, solver="auto"))
    model = Pipeline(stages=stages).fit(prepared)
    lo, hi = SCORE_CLIP
    scored = (model.transform(prepared)
              .withColumn("deep_fusion_score", F.least(F.greatest(F.col("_pred"), F.lit(lo)), F.lit(hi))))
    keep = [c for c in records.columns] + ["fusion_target", "deep_fusion_score"]
    scored = scored.select(*keep)
    return scored, fusion_topic_scores(scored)


def genre_mode(records: DataFrame, label: str = "audio_genre_label") -> DataFrame:
    """Most frequent label per topic; ties -> smallest label."""
    counts = (records.where(F.col("topic").isNotNull() & F.col(label).isNotNull())
              .groupBy("topic", label).agg(F.count(F.lit(1)).alias("_n")))
    w = Window.partitionBy("topic").orderBy(F.desc("_n"), F.asc(label))
    return counts.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("topic", label)


def fusion_topic_scores(scored: DataFrame) -> DataFrame:
    """Mean and max score per topic plus the genre mode."""
    agg = (scored.where(F.col("topic").isNotNull()).groupBy("topic")
           .agg(F.avg("deep_fusion_score").alias("deep_fusion_score"),
                F.max("deep_fusion_score").alias("deep_fusion_max")))
    return agg.join(genre_mode(scored), "topic", "left")


# --- J1 and the weighted multimodal score ---------------------------------------

def sample_std3(a: Column, b: Column, c: Column) -> Column:
    m = (a + b + c) / 3.0
    return F.sqrt(((a - m) ** 2 + (b - m) ** 2 + (c - m) ** 2) / 2.0)


def multimodal_summary(final: DataFrame, modal: DataFrame, nodes: DataFrame, forecasts: DataFrame,
                       deep_topics: DataFrame) -> DataFrame:
    """J1 + N3 + N6 + P24-P26 + W6 over topic-level tables."""
    m = (final.join(modal, "topic", "left").join(nodes, "topic", "left")
         .join(forecasts, "topic", "left").join(deep_topics.drop("audio_genre_label")
                                                if "audio_genre_label" in modal.columns
                                                and "audio_genre_label" in deep_topics.columns
                                                else deep_topics, "topic", "left"))
    m = m.withColumn("_centrality", F.coalesce("weighted_degree", F.lit(0.0))
                     + F.coalesce("pagerank", F.lit(0.0)) + F.coalesce("betweenness", F.lit(0.0)))
    m = m.checkpoint()
    # All five min-max normalisers from one aggregate
    norms = (("visual_energy", "visual_energy_norm"), ("visual_innovation", "visual_innovation_norm"),
             ("audio_energy_score", "audio_energy_norm"), ("audio_novelty_signal", "audio_novelty_norm"),
             ("_centrality", "network_centrality_norm"))
    filled = {src: F.coalesce(F.col(src).cast("double"), F.lit(0.0)) for src, _ in norms}
    rng = m.agg(*[F.min(filled[src]).alias(f"_lo{i}") for i, (src, _) in enumerate(norms)],
                *[F.max(filled[src]).alias(f"_hi{i}") for i, (src, _) in enumerate(norms)])
    m = m.crossJoin(one_row(rng))
    for i, (src, out) in enumerate(norms):
        m = m.withColumn(out, minmax(filled[src], f"_lo{i}", f"_hi{i}"))
    m = m.drop("_centrality", *[f"_lo{i}" for i in range(len(norms))],
               *[f"_hi{i}" for i in range(len(norms))])
    for c in ("forecast_growth_score", "forecast_confidence", "deep_fusion_score"):
        m = m.withColumn(c, F.coalesce(F.col(c).cast("double"), F.lit(0.5)))
    align = F.least(F.greatest(1.0 - sample_std3(F.col("trend_score"), F.col("visual_energy_norm"),
                                                 F.col("audio_energy_norm")), F.lit(0.0)), F.lit(1.0))
    m = m.withColumn("cross_modal_alignment", align)
    score = None
    for c, w in MULTIMODAL_WEIGHTS:
        term = F.lit(w) * F.col(c)
        score = term if score is None else score + term
    m = m.withColumn("multimodal_final_score", score)
    # topic-level table (bounded by the configured topics): a global rank is cheap
    rank_w = Window.orderBy(F.desc("multimodal_final_score"))
    return (m.withColumn("multimodal_rank", F.dense_rank().over(rank_w).cast("double"))
            .orderBy(F.desc("multimodal_final_score"), F.asc("topic")))
