"""Registered queries: feature filling, the learned fusion and the softmax
membership on plain aggregates of the given tables, so that SQL can check them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidewatch.operators import fusion as FU
from tidewatch.operators import topics as TP
from tidewatch.plans.registry import register
from tidewatch.sources import tables


def fusion_records(spark, sf_dir):
    """Line items in the schema of scored records, with gaps in every feature."""
    n = F.col("l_linenumber")
    return tables.read_table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + n).alias("source_item_id"),
        F.concat("l_returnflag", "l_linestatus").alias("topic"),
        F.when(n != 7, F.concat(F.lit("s"), (F.col("l_suppkey") % 5).cast("string"))).alias("source"),
        F.when(n != 2, F.concat(F.lit("g"), (F.col("l_partkey") % 4).cast("string"))).alias("audio_genre_label"),
        F.when(n != 3, F.col("l_discount") * 10 - 0.5).alias("sentiment"),
        F.when(n != 5, F.col("l_quantity") / 50).alias("engagement_norm"),
        F.when(n != 4, F.col("l_tax") * 10).alias("visual_brightness"))


RECORDS_SQL = """WITH r AS (
  SELECT l_orderkey * 10 + l_linenumber AS source_item_id, l_returnflag || l_linestatus AS topic,
    CASE WHEN l_linenumber <> 7 THEN 's' || (l_suppkey % 5) END AS source,
    CASE WHEN l_linenumber <> 2 THEN 'g' || (l_partkey % 4) END AS audio_genre_label,
    CASE WHEN l_linenumber <> 3 THEN l_discount * 10 - 0.5 END AS sentiment,
    CASE WHEN l_linenumber <> 5 THEN l_quantity / 50 END AS engagement_norm,
    CASE WHEN l_linenumber <> 4 THEN l_tax * 10 END AS visual_brightness
  FROM lineitem)"""


@register("p23_fill_features", RECORDS_SQL + """
SELECT source_item_id, round(coalesce(sentiment, 0.0), 6) AS sentiment,
  round(coalesce(engagement_norm, 0.0), 6) AS engagement_norm,
  round(coalesce(visual_brightness, 0.0), 6) AS visual_brightness, coalesce(source, 'unknown') AS source,
  coalesce(topic, 'unknown') AS topic, coalesce(audio_genre_label, 'unknown') AS audio_genre_label
FROM r""")
def p23_fill_features(spark, sf_dir):
    """Features as the regression sees them; absent columns are left out."""
    filled, num, cat = FU.fill_features(fusion_records(spark, sf_dir))
    return filled.select("source_item_id", *[F.col(f"_f_{c}").alias(c) for c in num + cat])


_A8_SQL = """
g AS (SELECT topic, audio_genre_label FROM (
  SELECT topic, audio_genre_label, row_number() OVER (PARTITION BY topic ORDER BY count(*) DESC, audio_genre_label) AS rn
  FROM r WHERE topic IS NOT NULL AND audio_genre_label IS NOT NULL GROUP BY 1, 2) WHERE rn = 1)
SELECT s.topic, round(avg(s.score), @d) AS deep_fusion_score, round(max(s.score), @d) AS deep_fusion_max,
  any_value(g.audio_genre_label) AS audio_genre_label
FROM s LEFT JOIN g ON g.topic = s.topic WHERE s.topic IS NOT NULL GROUP BY s.topic"""


@register("a8_fusion_topic_scores", RECORDS_SQL + """,
s AS (SELECT topic, coalesce(visual_brightness, 0.25) AS score FROM r),""" + _A8_SQL.replace("@d", "6"))
def a8_fusion_topic_scores(spark, sf_dir):
    """Mean, maximum and genre mode per topic of given record scores."""
    scored = fusion_records(spark, sf_dir).withColumn("deep_fusion_score", F.coalesce("visual_brightness", F.lit(0.25)))
    return FU.fusion_topic_scores(scored)


@register("m1_learned_fusion", RECORDS_SQL + """,
tm AS (SELECT topic, avg(engagement_norm) AS m FROM r WHERE topic IS NOT NULL GROUP BY topic),
s AS (SELECT r.topic, least(greatest(0.55 * coalesce(engagement_norm, 0.0) + 0.25 * ((coalesce(sentiment, 0.0) + 1) / 2)
        + 0.20 * coalesce(tm.m, 0.0), 0.0), 1.5) AS score
      FROM r LEFT JOIN tm ON tm.topic = r.topic),""" + _A8_SQL.replace("@d", "3"))
def m1_learned_fusion(spark, sf_dir):
    """The fitted regression, per topic, to three places.  Its target is a linear
    function of the filled features, so SQL gives what a right fit predicts."""
    _, topics = FU.deep_fusion(fusion_records(spark, sf_dir))
    return topics.select("topic", F.round("deep_fusion_score", 3).alias("deep_fusion_score"),
                         F.round("deep_fusion_max", 3).alias("deep_fusion_max"), "audio_genre_label")


@register("x11_p33_softmax_membership", """
WITH e AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS d
           FROM embeddings WHERE label IS NOT NULL),
c AS (SELECT label, d, avg(v) AS m FROM e GROUP BY label, d),
cn AS (SELECT label, greatest(sqrt(sum(m * m)), 1e-12) AS n FROM c GROUP BY label),
en AS (SELECT vec_id, greatest(sqrt(sum(v * v)), 1e-12) AS n FROM e GROUP BY vec_id),
dots AS (SELECT e.vec_id, e.label, c.label AS other, sum(e.v * c.m) AS dot
         FROM e JOIN c ON c.d = e.d GROUP BY e.vec_id, e.label, c.label),
s AS (SELECT dots.*, dot / (cn.n * en.n) AS sim FROM dots JOIN cn ON cn.label = dots.other JOIN en ON en.vec_id = dots.vec_id)
SELECT vec_id, label, round(sum(exp(sim)) FILTER (other = label) / sum(exp(sim)), 6) AS cluster_probability
FROM s GROUP BY vec_id, label""")
def x11_p33_softmax_membership(spark, sf_dir):
    """Every labelled embedding against the mean vector of each label (one row
    of means per label goes through the driver, as the centroids of a fit do)."""
    emb = tables.read_table(spark, sf_dir, "embeddings").where("label IS NOT NULL").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    means = (emb.select("label", F.posexplode("embedding").alias("d", "v")).groupBy("label", "d").agg(F.avg("v").alias("m"))
             .groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda x: x["m"]).alias("center"))
             .orderBy("label").collect())
    if not means:
        return emb.select("vec_id", "label", F.lit(None).cast("double").alias("cluster_probability"))
    index = F.create_map(*[F.lit(x) for i, r in enumerate(means) for x in (r["label"], i)])
    assigned = emb.withColumn("cluster", index[F.col("label")])
    out = TP.softmax_membership(assigned, np.array([r["center"] for r in means], dtype=float))
    return out.select("vec_id", "label", "cluster_probability")
