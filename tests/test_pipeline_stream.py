"""End-to-end batch run with all sinks, and stream/batch equality."""

import os
import tempfile

from pyspark.sql import functions as F

from tidewatch.operators import series as S
from tidewatch.plans import params
from tidewatch.plans.pipeline import run_pipeline, write_outputs
from tidewatch.sources import tables
from tidewatch.streaming import mentions as ST

SF = "/root/testdata/sf0.001"


def test_pipeline_writes_every_table(spark):
    rec = tables.signals(spark, SF).withColumn("media_url", F.col("source_item_id"))
    out = run_pipeline(rec, tables.pixels(spark, SF), lexicon=dict(params.LEXICON),
                       genre_keywords=params.FIXTURE_GENRE_KEYWORDS,
                       genome_axes=params.FIXTURE_GENOME_AXES)
    path = tempfile.mkdtemp(prefix="tidewatch-out-")
    write_outputs(out, path, log=spark.createDataFrame([(1, "live")], "iteration long, mode string"))
    names = set(os.listdir(path))
    for t in ("final_topic_scores", "multimodal_topic_summary", "scenario_planning",
              "explainability_summary", "topic_clusters", "document_topics", "scenario_brief", "raw_signals",
              "harvest_log", "explainability_report"):
        assert t in names
    assert spark.read.text(os.path.join(path, "scenario_brief")).first()[0].startswith("# ")
    mm = spark.read.parquet(os.path.join(path, "multimodal_topic_summary"))
    assert mm.count() == 5
    assert mm.where("multimodal_rank = 1").count() >= 1
    assert spark.read.parquet(os.path.join(path, "scenario_planning")).count() == 25
    clusters = spark.read.parquet(os.path.join(path, "topic_clusters"))
    assert clusters.agg(F.sum("document_count")).first()[0] == rec.count()


def test_stream_daily_counts_equal_batch(spark):
    landed = tempfile.mkdtemp(prefix="tidewatch-landed-")
    tables.read_table(spark, SF, "events").coalesce(1).write.mode("overwrite").parquet(landed + "/ev")
    streamed = ST.run_complete(spark, ST.daily_counts(ST.mention_stream(spark, landed + "/ev")), "test-t4")
    batch = S.daily_series(tables.mentions(spark, SF))
    a = sorted((r["topic"], r["day"], r["mentions"]) for r in streamed.collect())
    b = sorted((r["topic"], r["day"], r["mentions"]) for r in batch.collect())
    assert a == b and len(a) > 0


def test_partials_equal_batch_summary(spark):
    from tidewatch.operators import scoring as SC
    m = tables.mentions(spark, SF).withColumn("text", F.lit(""))
    direct = {(r["topic"], r["source"]): r for r in SC.source_summary(SC.prepare_records(m)).collect()}
    a = SC.summary_partials(m.where("event_id % 2 = 0").withColumn("sentiment", F.lit(0.0)))
    b = SC.summary_partials(m.where("event_id % 2 = 1").withColumn("sentiment", F.lit(0.0)))
    merged = {(r["topic"], r["source"]): r
              for r in SC.source_summary_from_partials(SC.merge_partials(a, b)).collect()}
    assert set(direct) == set(merged)
    for k, r in direct.items():
        for c in ("mention_count", "avg_engagement", "total_engagement_raw", "trend_score"):
            assert merged[k][c] == __import__("pytest").approx(r[c], rel=1e-9, abs=1e-12)


def test_continuous_rescoring_log(spark):
    landed = tempfile.mkdtemp(prefix="tidewatch-landed-")
    ev = tables.read_table(spark, SF, "events")
    for lo, hi in ((1, 5), (5, 15), (15, 32)):   # three files, appended in event-time order
        ev.where((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < hi)) \
          .coalesce(1).write.mode("append").parquet(landed + "/ev")
    log = ST.continuous_rescoring(spark, landed + "/ev", "test-rescoring").orderBy("iteration").collect()
    assert [r["iteration"] for r in log] == list(range(1, len(log) + 1))
    assert log[-1]["mentions_seen"] == ev.count()
    from tidewatch.operators import scoring as SC
    batch = SC.topic_scores(SC.source_summary(SC.prepare_records(
        tables.mentions(spark, SF).withColumn("text", F.lit("")))))
    assert log[-1]["top_topic"] == batch.first()["topic"]


def _days(spark, path, lo, hi, ids="event_id >= 0"):
    (tables.read_table(spark, SF, "events").where((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < hi)).where(ids)
     .coalesce(1).write.mode("append").parquet(path))


def test_a_stopped_stream_resumes_in_its_folder(spark):
    base = tempfile.mkdtemp(prefix="tidewatch-resume-")
    landed = base + "/landed"
    _days(spark, landed, 1, 8)
    first = ST.continuous_rescoring(spark, landed, base=base + "/run")
    assert [r["iteration"] for r in first.orderBy("iteration").collect()] == [1]
    for lo in (8, 12, 16, 20):
        _days(spark, landed, lo, lo + 4)
    log = ST.continuous_rescoring(spark, landed, base=base + "/run").orderBy("iteration").collect()
    assert [r["iteration"] for r in log] == [1, 2, 3, 4, 5]
    seen = tables.read_table(spark, SF, "events").where(F.dayofmonth("ts") < 24).count()
    assert log[-1]["mentions_seen"] == seen
    assert len([d for d in os.listdir(base + "/run/state") if d.startswith("batch_id=")]) == 3


def test_late_rows_are_dropped_and_repeats_count_once(spark):
    base = tempfile.mkdtemp(prefix="tidewatch-late-")
    landed = base + "/landed"
    _days(spark, landed, 1, 8)
    _days(spark, landed, 8, 10, "event_id % 2 = 0")
    _days(spark, landed, 8, 10, "event_id % 2 = 0")     # the same rows once more
    _days(spark, landed, 1, 3)                           # late: the watermark is at day 8
    _days(spark, landed, 20, 21)
    s = ST.mention_stream(spark, landed, max_files_per_trigger=1)
    days = {}
    for r in ST.run_append(spark, ST.daily_counts(s, "1 day"), "late", base + "/daily").collect():
        days[r["day"].day] = days.get(r["day"].day, 0) + r["mentions"]
    ev = tables.read_table(spark, SF, "events").groupBy(F.dayofmonth("ts").alias("d")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_id") % 2 == 0).alias("even")).collect()
    want = {r["d"]: r["n"] for r in ev if r["d"] < 8} | {r["d"]: 2 * r["even"] for r in ev if r["d"] in (8, 9)}
    assert {d: n for d, n in days.items() if d < 10} == want
    kept = ST.run_append(spark, ST.dedup_ids(s, "2 days"), "dedup", base + "/dedup")
    assert kept.groupBy("event_id").count().where("count > 1").count() == 0
