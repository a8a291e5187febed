"""Registered queries vs. their DuckDB oracle on the smallest fixture."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidewatch.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["p1_clean_text", "p3_lexicon_sentiment", "n1_source_max_scaling", "a1_source_summary",
        "a2_topic_scores", "n5b_novelty_by_mentions", "j5_f7_timeline", "w3_w4_series_stats",
        "a6_weekly_series", "f5_momentum_backtest", "p7_p9_topic_defaults", "a12_pixel_stats",
        "p13_audio_scores", "p14_audio_genre", "a3_modal_topic_summary", "x5_similarity_edges",
        "p15_genome_axes", "p16_p17_genome", "p23_fill_features", "a8_fusion_topic_scores", "m1_learned_fusion",
        "x11_p33_softmax_membership", "s11_source_union", "s13_s14_harvest_log", "t1_t2_rescored_topics",
        "k1_published_runs", "f1_ridge_momentum_forecast", "x9_singular_value_powers"]


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        t = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = None if math.isnan(v) else round(v, 5)
            elif hasattr(v, "isoformat"):
                v = v.isoformat()[:10]
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_oracle_key_is_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _norm(rows, df.columns) == _norm(rel.fetchall(), ocols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "final_score_with_novelty" in df.columns
