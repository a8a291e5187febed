"""Golden replays: published demo tables pushed through our operators."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import explain as E
from tidewatch.operators import forecast as FC
from tidewatch.operators import fusion as FU
from tidewatch.operators import modal as M
from tidewatch.operators import network as N
from tidewatch.operators import scoring as SC
from tidewatch.operators import strategy as ST

TOPICS = ["AI music", "Digital art", "Mindfulness", "Sustainable fashion"]
SOURCES = ["NewsAPI", "Reddit", "Spotify", "X"]

# (n per source, avg_engagement per source, total per source, avg_sentiment)
G1_IN = {
    "AI music": (14, (0.5982142857142857, 0.6767968056787933, 0.8764880952380952, 0.5842807711319822),
                 (67, 3051, 1178, 2364), 0.19805194805194803),
    "Digital art": (12, (0.6041666666666666, 0.7440476190476191, 0.39496527777777773, 0.7350057670126874),
                    (58, 2875, 455, 2549), 0.07575757575757575),
    "Mindfulness": (8, (0.484375, 0.43167701863354035, 0.7513020833333334, 0.47231833910034604),
                    (31, 1112, 577, 1092), 0.11250000000000002),
    "Sustainable fashion": (10, (0.6625, 0.5012422360248447, 0.4416666666666667, 0.41038062283737026),
                            (53, 1614, 424, 1186), 0.2503409090909091),
}
G1_OUT = {
    "AI music": (56, 0.9198051948051948, 0.12639930997067794, 1.0, 0.9198051948051948,
                 "High trend / High novelty"),
    "Digital art": (48, 0.8127698381639566, 0.07616610405380599, 0.7522823707721872, 0.7869277921713441,
                    "High trend / High novelty"),
    "Sustainable fashion": (40, 0.7054781511885858, -0.06217844430941664, 0.07005668137776402,
                            0.5743784723942649, "High trend / Lower novelty"),
    "Mindfulness": (32, 0.6526641972298657, -0.07638482805558722, 0.0, 0.5173106479223992,
                    "High trend / Lower novelty"),
}
G2_EDGES = [("AI music", "Mindfulness", 0.12308883775969251), ("AI music", "Digital art", 0.1154301720305102),
            ("Digital art", "Mindfulness", 0.11135694040290409),
            ("Mindfulness", "Sustainable fashion", 0.12386246294794806),
            ("AI music", "Sustainable fashion", 0.10544432609672942)]
G2_NODES = {
    "AI music": (0.292446416325164, 0.3333333333333333, 3, 0.3439633358869321),
    "Digital art": (0.20110849739458067, 0.0, 2, 0.2267871124334143),
    "Mindfulness": (0.30354810673097365, 0.0, 3, 0.35830824111054466),
    "Sustainable fashion": (0.20289697954928215, 0.0, 2, 0.2293067890446775),
}
G3 = {
    "AI music": ([4, 12, 10, 7, 6, 4, 5, 5, 3], (0.247656, 0.338204, 0.414139), 6.353647, 7.730379,
                 0.186872, 0.914052),
    "Digital art": ([4, 6, 6, 4, 7, 5, 4, 8, 4], (0.466737, 0.330134, 0.203129), 17.432829, 35.132069,
                    0.415067, 0.927201),
    "Mindfulness": ([7, 2, 2, 3, 2, 7, 3, 4, 2], (0.464965, 0.319004, 0.216032), 10.033384, 19.379759,
                    0.313543, 0.926758),
    "Sustainable fashion": ([2, 3, 6, 7, 9, 2, 4, 6, 1], (0.396266, 0.339291, 0.264443), 12.486885,
                            24.610888, 0.480265, 0.909584),
}
G4 = {
    "AI music": (0.6069318181818181, 0.6676, 0.7252916666666666, 0.6375, 0.6763763713199872,
                 0.7662075401150941, 0.8031066061592991, 1.0),
    "Digital art": (0.7321515151515151, 0.7726000000000001, 0.5934166666666667, 0.65275, 0.6056222828004308,
                    0.8543663499784953, 0.7340167095897806, 2.0),
    "Sustainable fashion": (0.5337619318181818, 0.5606, 0.46950000000000003, 0.39849999999999997,
                            0.5294973400973695, 0.7963690415292947, 0.427250755446104, 3.0),
    "Mindfulness": (0.4469375, 0.41080000000000005, 0.2655416666666667, 0.300125, 0.5431375915139212,
                    0.623184150038906, 0.2843673867488912, 4.0),
}


def _final(spark):
    rows = []
    for t, (n, avg, tot, sent) in G1_IN.items():
        for s, a, x in zip(SOURCES, avg, tot):
            rows.append((t, s, n, a, float(x), sent))
    summary = spark.createDataFrame(
        rows, "topic string, source string, mention_count long, avg_engagement double, "
              "total_engagement_raw double, avg_sentiment double")
    return SC.topic_scores(summary)


def test_g1_source_to_topic(spark):
    out = {r["topic"]: r for r in _final(spark).collect()}
    for t, (cnt, trend, nov, nn, final, quad) in G1_OUT.items():
        r = out[t]
        assert r["mention_count"] == cnt
        assert r["source_count"] == 4
        assert r["trend_score"] == pytest.approx(trend, abs=1e-12)
        assert r["novelty_score"] == pytest.approx(nov, abs=1e-12)
        assert r["novelty_score_norm"] == pytest.approx(nn, abs=1e-12)
        assert r["final_score_with_novelty"] == pytest.approx(final, abs=1e-12)
        assert r["quadrant"] == quad
    assert [r["topic"] for r in _final(spark).collect()] == list(G1_OUT)


def _graph(spark):
    edges = spark.createDataFrame(G2_EDGES, "source_topic string, target_topic string, weight double")
    nodes = spark.createDataFrame([(t,) for t in TOPICS], "topic string")
    return nodes, edges


def test_g2_network_centralities(spark):
    nodes, edges = _graph(spark)
    pr = {r["topic"]: r["pagerank"] for r in N.pagerank(nodes, edges).collect()}
    bt = {r["topic"]: r["betweenness"] for r in N.betweenness(nodes, edges).collect()}
    dg = {r["topic"]: r for r in N.degrees(nodes, edges).collect()}
    for t, (p, b, d, wd) in G2_NODES.items():
        assert pr[t] == pytest.approx(p, abs=1e-12)
        assert bt[t] == pytest.approx(b, abs=1e-12)
        assert dg[t]["degree"] == d
        assert dg[t]["weighted_degree"] == pytest.approx(wd, abs=1e-12)
    assert sum(pr.values()) == pytest.approx(1.0, abs=1e-9)


def test_g2_isolated_topic_is_dangling(spark):
    nodes = spark.createDataFrame([(t,) for t in TOPICS + ["Lonely"]], "topic string")
    _, edges = _graph(spark)
    pr = {r["topic"]: r["pagerank"] for r in N.pagerank(nodes, edges).collect()}
    assert sum(pr.values()) == pytest.approx(1.0, abs=1e-9)
    assert pr["Lonely"] > 0


@pytest.mark.parametrize("topic", list(G3))
def test_g3_ensemble_weights(topic):
    y, (wb, wh, wm), f4, f8, growth, conf = G3[topic]
    fc, w = FC.ensemble(np.array(y, dtype=float))
    assert w["bayesian"] / w["momentum"] == pytest.approx(wb / wm, rel=1e-5)
    assert sum(w.values()) == pytest.approx(1.0)
    assert all(0 < v < 1 for v in w.values())
    if topic in ("AI music", "Sustainable fashion"):
        assert w["holt"] / w["momentum"] == pytest.approx(wh / wm, rel=1e-5)
        assert float(fc[:4].sum()) == pytest.approx(f4, abs=1e-5)
        assert float(fc.sum()) == pytest.approx(f8, abs=1e-5)
    hist4 = float(sum(y[-4:]))
    g, c = FC.growth_and_confidence(f4, hist4, len(y), (wb, wh, wm))
    assert g == pytest.approx(growth, abs=1e-5)
    assert c == pytest.approx(conf, abs=1e-5)


def test_g4_multimodal(spark):
    final = _final(spark)
    modal = spark.createDataFrame([(t, v[0], v[1], v[2], v[3]) for t, v in G4.items()],
                                  "topic string, visual_energy double, visual_innovation double, "
                                  "audio_energy_score double, audio_novelty_signal double")
    nodes = spark.createDataFrame([(t, *v) for t, v in G2_NODES.items()],
                                  "topic string, pagerank double, betweenness double, degree long, "
                                  "weighted_degree double")
    fc = spark.createDataFrame([(t, v[4], v[5]) for t, v in G3.items()],
                               "topic string, forecast_growth_score double, forecast_confidence double")
    deep = spark.createDataFrame([(t, v[4]) for t, v in G4.items()], "topic string, deep_fusion_score double")
    mm = {r["topic"]: r for r in FU.multimodal_summary(final, modal, nodes, fc, deep).collect()}
    for t, v in G4.items():
        assert mm[t]["cross_modal_alignment"] == pytest.approx(v[5], abs=1e-9)
        assert mm[t]["multimodal_final_score"] == pytest.approx(v[6], abs=1e-6)
        assert mm[t]["multimodal_rank"] == v[7]
    expl = {r["topic"]: r for r in E.explainability(FU.multimodal_summary(final, modal, nodes, fc, deep))
            .collect()}
    # Three components tie at 1.0; declared order decides
    assert (expl["AI music"]["top_driver_1"], expl["AI music"]["top_driver_2"],
            expl["AI music"]["top_driver_3"]) == ("novelty_score_norm", "audio_energy_norm",
                                                  "network_centrality_norm")
    assert expl["AI music"]["risk_flags"] == "none"


def test_g5_scenario_and_signature(spark):
    genome = spark.createDataFrame(
        [("AI music", 0.9209590414934661, 0.35211267605633806, 0.0, 0.44014084507042256, 1.0)],
        "topic string, innovation_score double, tradition_score double, wellness_score double, "
        "community_score double, expression_score double")
    genome = genome.withColumn("genome_signature", ST.signature(
        [f"{n}_score" for n in ("innovation", "tradition", "wellness", "community", "expression")],
        ["innovation", "tradition", "wellness", "community", "expression"]))
    assert genome.first()["genome_signature"] == "Expression + Innovation"
    mm = spark.createDataFrame([("AI music", 0.8031066061592991)], "topic string, multimodal_final_score double")
    plan = {r["scenario"]: r for r in ST.scenario_plan(mm, genome).collect()}
    r = plan["AI Regulation Crackdown"]
    assert r["impact_score"] == pytest.approx(-0.459220301066426, abs=1e-12)
    assert r["adjusted_multimodal_score"] == pytest.approx(0.6883015308926925, abs=1e-12)
    assert len(plan) == 5


def test_g7_genre_share(spark):
    rows = [("A", "pop")] * 45 + [("A", "indie")] * 2 + [("A", "ambient")]
    df = spark.createDataFrame(rows, "topic string, audio_genre_label string").withColumn(
        "source", F.lit("s"))
    for c in M.MODAL_MEANS:
        df = df.withColumn(c, F.lit(0.5))
    out = {r["audio_genre_label"]: r["share_within_topic"] for r in M.audio_genre_summary(df).collect()}
    assert out["pop"] == pytest.approx(0.9375)
    assert out["indie"] == pytest.approx(2 / 48)
    assert out["ambient"] == pytest.approx(1 / 48)
    assert M.modal_topic_summary(df).first()["dominant_audio_genre"] == "pop"


def test_signature_and_drivers_math():
    assert math.isclose(0.35 * 0.58 + 0.35 * 0.62 + 0.30 * 0.60, 0.6)


# Second published case: 7 topics, 9 edges (includes paths with equal-length ties).
G2B_EDGES = [("AI music", "Digital art", 0.13796958492339942), ("AI music", "Mindfulness", 0.10232437991029629),
             ("Digital art", "Sustainable fashion", 0.1188545952662132), ("Mindfulness", "cycling", 0.14188777420317814),
             ("Mindfulness", "running", 0.12026861998299083),
             ("Mindfulness", "Sustainable fashion", 0.08989066552872636),
             ("cycling", "running", 0.07724184349774336), ("Mindfulness", "swimming", 0.0751970288283245),
             ("cycling", "swimming", 0.06432147058560907)]
G2B_NODES = {
    "AI music": (0.13009947570619027, 0.0, 2, 0.2402939648336957),
    "Digital art": (0.14096470752201393, 0.0, 2, 0.2568241801896126),
    "Mindfulness": (0.26973539824578796, 0.6666666666666666, 5, 0.5295684684535161),
    "Sustainable fashion": (0.11579821975361375, 0.26666666666666666, 2, 0.20874526079493955),
    "cycling": (0.15157344200306302, 0.06666666666666667, 3, 0.28345108828653054),
    "running": (0.10860759054507428, 0.0, 2, 0.1975104634807342),
    "swimming": (0.08322116622425665, 0.26666666666666666, 2, 0.13951849941393357),
}


def test_g2_second_network(spark):
    edges = spark.createDataFrame(G2B_EDGES, "source_topic string, target_topic string, weight double")
    nodes = spark.createDataFrame([(t,) for t in G2B_NODES], "topic string")
    pr = {r["topic"]: r["pagerank"] for r in N.pagerank(nodes, edges).collect()}
    bt = {r["topic"]: r["betweenness"] for r in N.betweenness(nodes, edges).collect()}
    dg = {r["topic"]: r for r in N.degrees(nodes, edges).collect()}
    for t, (p, b, d, wd) in G2B_NODES.items():
        assert pr[t] == pytest.approx(p, abs=1e-9)
        assert bt[t] == pytest.approx(b, abs=1e-12)
        assert dg[t]["degree"] == d
        assert dg[t]["weighted_degree"] == pytest.approx(wd, abs=1e-12)


def test_r8_scenario_pivot_and_r7_unpivot(spark):
    plan = spark.createDataFrame(
        [("A", "s1", 0.1, 0.5), ("B", "s1", 0.2, 0.7), ("A", "s2", 0.0, 0.4), ("B", "s2", -0.1, 0.3)],
        "topic string, scenario string, impact_score double, adjusted_multimodal_score double")
    piv = {r["scenario"]: r for r in ST.pivot_scenarios(plan, ["A", "B"]).collect()}
    assert piv["s1"]["A"] == 0.5 and piv["s2"]["B"] == 0.3
    assert ST.scenario_leaders(plan).orderBy("scenario").select("topic").collect()[0]["topic"] == "B"
    genome = spark.createDataFrame([("A", 0.1, 0.2, 0.3, 0.4, 0.5)],
                                   "topic string, innovation_score double, tradition_score double, "
                                   "wellness_score double, community_score double, expression_score double")
    long = {r["dimension"]: r["score"] for r in ST.unpivot_genome(genome).collect()}
    assert long == {"innovation_score": 0.1, "tradition_score": 0.2, "wellness_score": 0.3,
                    "community_score": 0.4, "expression_score": 0.5}


def _ring(spark, n):
    nodes = spark.range(n).select(F.format_string("t%05d", "id").alias("topic"))
    edges = spark.range(n).select(F.format_string("t%05d", "id").alias("source_topic"),
                                  F.format_string("t%05d", (F.col("id") + 1) % n).alias("target_topic"), F.lit(0.5).alias("weight"))
    return nodes, edges


def test_six_thousand_topics_pass_pagerank_and_edges(spark):
    nodes, edges = _ring(spark, 6000)
    pr = N.pagerank(nodes, edges).agg(F.min("pagerank"), F.max("pagerank"), F.count("*")).first()
    assert pr[2] == 6000 and abs(pr[0] - 1 / 6000) < 1e-9 and abs(pr[1] - 1 / 6000) < 1e-9
    sim = edges.select(F.least("source_topic", "target_topic").alias("topic_a"),
                       F.greatest("source_topic", "target_topic").alias("topic_b"), F.col("weight").alias("similarity"))
    assert N.similarity_edges(sim).count() == 6000
    bt = N.betweenness(nodes, edges, sources=8)
    assert bt.count() == 6000


def test_pagerank_that_does_not_settle_raises(spark):
    nodes, edges = _ring(spark, 4)
    edges = edges.withColumn("weight", F.when(F.col("source_topic") == "t00000", 9.0).otherwise(F.col("weight")))
    with pytest.raises(RuntimeError):
        N.pagerank(nodes, edges, max_iter=2, tol=1e-15)
