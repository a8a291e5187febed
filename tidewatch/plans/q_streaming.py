"""Registered queries: streaming operators run to completion over the events
table (landed as several files by Spark so the stream sees several batches)."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidewatch.operators import scoring as SC
from tidewatch.plans.fixture_sql import MENTIONS, with_ctes
from tidewatch.plans.registry import register
from tidewatch.session import scratch_path
from tidewatch.sources import config as C
from tidewatch.sources import ingest as I
from tidewatch.sources import publish as P
from tidewatch.sources import tables
from tidewatch.streaming import mentions as ST


FILE_EVENTS = 250_000   # events of a landed file, about


def landed_events(spark, sf_dir, repeats: bool = False) -> tuple[str, int]:
    """(path, files per week) of the events table landed by calendar week, appended
    in event-time order (as a harvester would), so the stream sees several
    batches arriving in order.  With ``repeats`` every third event of a week
    is landed a second time in the same week.

    Every week has the same number of files, one for few events, so a stream that
    takes that many at a time has a batch per week, whatever the size of the table
    and the number of tasks.  (A week of fewer events than files has fewer; batches then
    reach into the next week, still in order.)

    One pass writes a week-partitioned staging table; each week is then
    appended from its own partition (partition pruning), so landing costs two
    passes over the data, not one per week.
    """
    staging = scratch_path(spark, "staging-events")
    path = scratch_path(spark, "landed-events")
    ev = tables.read_table(spark, sf_dir, "events").withColumn(
        "week", F.date_format(F.date_trunc("week", F.col("ts").cast("timestamp")), "yyyy-MM-dd"))
    ev.write.mode("overwrite").partitionBy("week").parquet(staging)
    staged = spark.read.parquet(staging)
    weeks = {r["week"]: r["count"] for r in staged.groupBy("week").count().orderBy("week").collect()}  # calendar-bounded
    files = max(1, -(-max(weeks.values(), default=0) // FILE_EVENTS))
    for wk in weeks:
        week = staged.where(F.col("week") == F.lit(wk)).drop("week")
        if repeats:
            week = week.unionByName(week.where("event_id % 3 = 0"))
        week.repartition(files, "event_id").write.mode("append").parquet(path)
    return path, files


# The weeks' files arrive in order, the events of a week in any order: a week
# and a day of lateness are waited for.  In append mode a window is emitted
# when the watermark (last event minus LATENESS) has passed its end.
LATENESS = "8 days"
_PASSED = "<= (SELECT max(ts) - INTERVAL 8 DAY FROM events)"


def _stream(spark, sf_dir, repeats=False):
    return ST.mention_stream(spark, *landed_events(spark, sf_dir, repeats))


@register("t4_stream_daily_counts", with_ctes(MENTIONS) + f"""
SELECT topic, CAST(date AS DATE) AS day, CAST(count(*) AS BIGINT) AS mentions,
       round(sum(engagement), 6) AS engagement
FROM mentions WHERE date + INTERVAL 1 DAY {_PASSED} GROUP BY 1, 2""")
def t4_stream_daily_counts(spark, sf_dir):
    return ST.run_append(spark, ST.daily_counts(_stream(spark, sf_dir), LATENESS), "t4")


@register("t5_stream_trailing_week", with_ctes(MENTIONS) + f"""
SELECT topic, CAST(CAST(date AS DATE) - CAST(k AS INTEGER) AS DATE) AS window_start,
       CAST(count(*) AS BIGINT) AS mentions
FROM mentions, range(0, 7) t(k)
WHERE CAST(date AS DATE) - CAST(k AS INTEGER) + INTERVAL 7 DAY {_PASSED} GROUP BY 1, 2""")
def t5_stream_trailing_week(spark, sf_dir):
    return ST.run_append(spark, ST.trailing_week_counts(_stream(spark, sf_dir), LATENESS), "t5")


@register("t6_stream_weekly_counts", with_ctes(MENTIONS) + f"""
SELECT topic, CAST(date_trunc('week', CAST(date AS DATE)) AS DATE) AS week_start,
       CAST(count(*) AS BIGINT) AS mentions
FROM mentions WHERE date_trunc('week', CAST(date AS DATE)) + INTERVAL 7 DAY {_PASSED} GROUP BY 1, 2""")
def t6_stream_weekly_counts(spark, sf_dir):
    return ST.run_append(spark, ST.weekly_counts(_stream(spark, sf_dir), LATENESS), "t6")


@register("t7_stream_source_totals", with_ctes(MENTIONS) + """
SELECT topic, source, CAST(count(*) AS BIGINT) AS mention_count,
       round(sum(engagement), 6) AS total_engagement_raw
FROM mentions GROUP BY 1, 2""")
def t7_stream_source_totals(spark, sf_dir):
    return ST.run_complete(spark, ST.source_totals(_stream(spark, sf_dir)), "t7")


@register("t3_stream_dedup_ids", with_ctes(MENTIONS) + """
SELECT topic, CAST(count(DISTINCT event_id) AS BIGINT) AS mentions FROM mentions GROUP BY topic""")
def t3_stream_dedup_ids(spark, sf_dir):
    """A third of the events lands twice; each id is counted once."""
    kept = ST.run_append(spark, ST.dedup_ids(_stream(spark, sf_dir, repeats=True), LATENESS), "t3")
    return kept.groupBy("topic").agg(F.count(F.lit(1)).alias("mentions"))


@register("t1_t2_continuous_rescoring")
def t1_t2_continuous_rescoring(spark, sf_dir):
    """One harvest-log row per micro-batch with the top topic so far."""
    path, files = landed_events(spark, sf_dir)
    return ST.continuous_rescoring(spark, path, max_files_per_trigger=files).select(
        "iteration", "mode", "top_topic", "mentions_seen")


def _rescored_sql() -> str:
    from tidewatch.plans.q_scoring import _MENTIONS_PREPARED, A2_COLS, _a1_sql, _a2_sql

    return _a1_sql(_MENTIONS_PREPARED) + _a2_sql() + f"""
SELECT {A2_COLS}, (SELECT arg_max(topic, (final_score_with_novelty, topic)) FROM final) AS logged_top_topic,
       (SELECT CAST(count(*) AS BIGINT) FROM mentions WHERE topic IS NOT NULL) AS mentions_seen
FROM final"""


@register("t1_t2_rescored_topics", _rescored_sql())
def t1_t2_rescored_topics(spark, sf_dir):
    """Topic scores of the stream's state after its last batch, next to the
    harvest log's last row: what one batch run over all events gives."""
    base = scratch_path(spark, "rescored")
    path, files = landed_events(spark, sf_dir)
    log = ST.continuous_rescoring(spark, path, max_files_per_trigger=files, base=base)
    last = log.agg(F.max_by("top_topic", "iteration").alias("logged_top_topic"),
                   F.max_by("mentions_seen", "iteration").alias("mentions_seen"))
    return ST.rescored_topics(spark, base).crossJoin(F.broadcast(last))   # one row


def _two_runs_sql() -> str:
    """CTEs ``final`` (all events) and ``final_p`` (without the last day)."""
    import re

    from tidewatch.plans.fixture_sql import MENTIONS as M_CTE
    from tidewatch.plans.q_scoring import _MENTIONS_PREPARED, _a1_sql, _a2_sql

    full = _a1_sql(_MENTIONS_PREPARED) + _a2_sql()
    head = "WITH " + M_CTE + "\n"
    assert full.startswith(head)
    rest = full[len(head):]
    names = ("mentions", "smax", "prepared", "a1", "a1s", "source_summary", "g", "gs", "gt", "gn",
             "gr", "final_scores", "final")
    prev = re.sub(r"\b(" + "|".join(names) + r")\b", lambda m: m.group(1) + "_p", rest)
    cut = """,
mentions_p AS (SELECT * FROM mentions
               WHERE CAST(date AS DATE) < (SELECT max(CAST(date AS DATE)) FROM mentions))"""
    return head + rest + cut + prev


def _t8_sql() -> str:
    return _two_runs_sql() + """,
cr AS (SELECT topic, final_score_with_novelty AS s,
              row_number() OVER (ORDER BY final_score_with_novelty DESC, topic) AS r FROM final),
pr AS (SELECT topic, final_score_with_novelty AS s,
              row_number() OVER (ORDER BY final_score_with_novelty DESC, topic) AS r FROM final_p)
SELECT coalesce(pr.topic, cr.topic) AS topic, CAST(pr.r AS BIGINT) AS previous_rank,
       CAST(cr.r AS BIGINT) AS current_rank, CAST(pr.r - cr.r AS BIGINT) AS rank_gain,
       round(cr.s - pr.s, 6) AS score_change,
       CASE WHEN pr.r IS NULL THEN 'new' WHEN cr.r IS NULL THEN 'dropped'
            WHEN pr.r > cr.r THEN 'up' WHEN pr.r < cr.r THEN 'down' ELSE 'same' END AS movement
FROM pr FULL OUTER JOIN cr ON cr.topic = pr.topic"""


@register("t8_run_over_run", _t8_sql())
def t8_run_over_run(spark, sf_dir):
    """Ranking over all events vs. the ranking without the last day."""
    m = tables.mentions(spark, sf_dir).withColumn("text", F.lit(""))
    last = m.agg(F.max("date")).first()[0]
    curr = SC.topic_scores_from_records(m)
    prev = SC.topic_scores_from_records(m.where(F.col("date") < F.lit(last)))
    return ST.compare_runs(prev, curr)


_LOG = "iteration long, mode string, top_topic string, topic_model_method string"


def _log_sql() -> str:
    top = "(SELECT arg_max(topic, (final_score_with_novelty, topic)) FROM {0})"
    return _two_runs_sql() + f"""
SELECT CAST(1 AS BIGINT) AS iteration, 'batch' AS mode, {top.format('final_p')} AS top_topic,
       'n/a' AS topic_model_method, CAST(0 AS BIGINT) AS rows_before
UNION ALL SELECT CAST(2 AS BIGINT), 'batch', {top.format('final')}, 'n/a', CAST(1 AS BIGINT)"""


@register("s13_s14_harvest_log", _log_sql())
def s13_s14_harvest_log(spark, sf_dir):
    """Two harvest runs (without the last day, then all events), the second one
    repeated as after a failure; the log is scanned before each run, first
    where it does not exist."""
    m = tables.mentions(spark, sf_dir).withColumn("text", F.lit(""))
    last = m.agg(F.max("date")).first()[0]
    path, seen = f"{scratch_path(spark, 'harvest')}/log", []
    for run, records in enumerate((m.where(F.col("date") < F.lit(last)), m)):
        seen.append(C.load_table_or_empty(spark, path, _LOG).count())
        top = SC.topic_scores_from_records(records).agg(
            F.max_by("topic", F.struct("final_score_with_novelty", "topic")).alias("t")).first()["t"]
        for _ in range(run + 1):
            I.append_harvest_log(spark, path, run, "batch", top, "n/a")
    before = F.element_at(F.array(*[F.lit(n) for n in seen]), F.col("iteration").cast("int"))
    return C.load_table_or_empty(spark, path, _LOG).withColumn("rows_before", before)


@register("k1_published_runs", _two_runs_sql() + """
SELECT 'after failure' AS seen, CAST(1 AS BIGINT) AS run, topic, round(final_score_with_novelty, 6) AS score,
       (SELECT CAST(count(*) AS BIGINT) FROM source_summary_p) AS summary_rows FROM final_p
UNION ALL
SELECT 'after retry', CAST(2 AS BIGINT), topic, round(final_score_with_novelty, 6),
       (SELECT CAST(count(*) AS BIGINT) FROM source_summary) FROM final""")
def k1_published_runs(spark, sf_dir):
    """Two runs (without the last day, then all events) published as units.  The
    second one first fails in its second table and is then repeated; the
    scores a reader sees are read back after the failure and after the retry."""
    m = tables.mentions(spark, sf_dir).withColumn("text", F.lit(""))
    last = m.agg(F.max("date")).first()[0]
    path, seen = f"{scratch_path(spark, 'published')}/out", []

    def look(when):
        count = P.manifest(spark, path).where("name = 'source_summary'").select("run", F.col("row_count").alias("summary_rows"))
        run = P.last_run(spark, path)
        scores = P.read_published(spark, path, "final_topic_scores", run).select(
            F.lit(when).alias("seen"), F.lit(run).cast("bigint").alias("run"), "topic", F.col("final_score_with_novelty").alias("score"))
        seen.append(scores.join(F.broadcast(count.where(F.col("run") == run)), "run"))   # one row

    for run, records in ((1, m.where(F.col("date") < F.lit(last))), (2, m)):
        summary = SC.source_summary_one_pass(records).checkpoint()
        out = {"final_topic_scores": SC.topic_scores(summary), "source_summary": summary}
        if run == 2:
            broken = summary.withColumn("topic", F.raise_error(F.lit("this attempt ends here")).cast("string"))
            try:
                P.publish(spark, path, run, {**out, "source_summary": broken})
            except PySparkException:
                look("after failure")
        P.publish(spark, path, run, out)
    look("after retry")
    return seen[0].unionByName(seen[1])
