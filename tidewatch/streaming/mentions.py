"""Structured Streaming versions of the mention pipeline.

Sources are landed parquet files read with ``readStream``; event time is the
mention timestamp cast to TIMESTAMP (session time zone UTC; watermarks reject
TIMESTAMP_NTZ).  Sinks are ``foreachBatch`` writers into the shared
checkpoint folder: complete-mode results overwrite their table (idempotent on
replay), append-mode results are written per batch id (a replayed batch
overwrites its own partition).  State lives in the stream checkpoint.  A
restarted driver resumes where it stopped if it is given the same ``base``
folder; without one, a run gets a fresh folder of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators import scoring as SC
from tidewatch.session import scratch_path

EVENT_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                "value double, props string")


def mention_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                   schema: str = EVENT_SCHEMA) -> DataFrame:
    """Landed events -> streaming mentions with an event-time column."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    ev = reader.parquet(path)
    return ev.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_type").alias("topic"),
        F.concat(F.lit("u"), F.pmod(F.col("user_id"), F.lit(4)).cast("string")).alias("source"),
        F.col("value").alias("engagement"))


def daily_counts(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """T4: tumbling one-day windows per topic."""
    return (stream.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "1 day").alias("w"), "topic")
            .agg(F.count(F.lit(1)).alias("mentions"), F.sum("engagement").alias("engagement"))
            .select("topic", F.col("w.start").cast("date").alias("day"), "mentions", "engagement"))


def trailing_week_counts(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """T5: sliding 7-day windows advancing by one day."""
    return (stream.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "7 days", "1 day").alias("w"), "topic")
            .agg(F.count(F.lit(1)).alias("mentions"))
            .select("topic", F.col("w.start").cast("date").alias("window_start"), "mentions"))


def weekly_counts(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Tumbling Monday..Sunday weeks (epoch is a Thursday: offset 4 days)."""
    return (stream.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", "7 days", "7 days", "4 days").alias("w"), "topic")
            .agg(F.count(F.lit(1)).alias("mentions"))
            .select("topic", F.col("w.start").cast("date").alias("week_start"), "mentions"))


def source_totals(stream: DataFrame) -> DataFrame:
    """Running (topic, source) counts and engagement totals."""
    return (stream.groupBy("topic", "source")
            .agg(F.count(F.lit(1)).alias("mention_count"),
                 F.sum("engagement").alias("total_engagement_raw")))


def dedup_ids(stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Drop repeated mention ids arriving within the watermark."""
    return stream.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark(["event_id"])


# --- running a stream to completion into a table --------------------------------

def run_complete(spark: SparkSession, result: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run a streaming aggregate (complete mode) over everything available and
    return the table it maintains."""
    base = base or scratch_path(spark, name)
    out, ckpt = f"{base}/table", f"{base}/checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    q = (result.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)


def run_append(spark: SparkSession, result: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Run an append-mode stream; each batch lands in its own batch-id partition.

    A window is emitted once, when the watermark has passed its end; rows of
    windows that the watermark has passed are late and dropped."""
    base = base or scratch_path(spark, name)
    out, ckpt = f"{base}/table", f"{base}/checkpoint"

    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out))

    q = (result.writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    schema = T.StructType([*result.schema.fields, T.StructField("batch_id", T.IntegerType())])
    return spark.read.schema(schema).parquet(out).drop("batch_id")


# --- T1 / T2: continuous re-scoring with a harvest log ---------------------------

def continuous_rescoring(spark: SparkSession, landed_path: str, name: str = "rescoring",
                         max_files_per_trigger: int = 1, base: str | None = None) -> DataFrame:
    """T1 + T2: re-score all topics on every micro-batch.

    The running state is the (topic, source) partial table (counts, sums,
    maxima), so each batch costs its own rows plus a table bounded by
    topics x sources, however long the stream has run.  State versions and
    log rows are keyed by batch id: a replayed batch rewrites its own version
    and its own log row; versions that no replay can need are deleted.
    """
    base = base or scratch_path(spark, name)
    state, log, ckpt = f"{base}/state", f"{base}/log", f"{base}/checkpoint"
    stream = mention_stream(spark, landed_path, max_files_per_trigger)

    def score(batch: DataFrame, batch_id: int) -> None:
        fresh = SC.summary_partials(batch)
        parts = fresh
        if batch_id > 0:
            prev = spark.read.parquet(state).where(F.col("batch_id") == batch_id - 1).drop("batch_id")
            parts = SC.merge_partials(prev, fresh)
        (parts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(state))
        current = spark.read.parquet(state).where(F.col("batch_id") == batch_id).drop("batch_id")
        final = SC.topic_scores(SC.source_summary_from_partials(current))
        top = final.agg(F.max_by("topic", F.struct("final_score_with_novelty", "topic")).alias("top_topic"),
                        F.sum("mention_count").alias("mentions_seen"))
        row = top.select(F.lit(batch_id + 1).cast("bigint").alias("iteration"),
                         F.current_timestamp().alias("captured_at_utc"), F.lit("stream").alias("mode"),
                         "top_topic", F.lit("n/a").alias("topic_model_method"),
                         F.col("mentions_seen").cast("bigint").alias("mentions_seen"))
        (row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("iteration").parquet(log))
        if batch_id > 2:   # only the last batch can be replayed, from the version before it
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/batch_id={batch_id - 3}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    q = (stream.writeStream.foreachBatch(score).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(log)


def rescored_topics(spark: SparkSession, base: str) -> DataFrame:
    """The topic scores of the last version of the running state under ``base``."""
    state = spark.read.parquet(f"{base}/state")
    last = state.agg(F.max("batch_id")).first()[0]   # a partition column: one small number
    return SC.topic_scores(SC.source_summary_from_partials(state.where(F.col("batch_id") == last).drop("batch_id")))


# --- T8: run-over-run comparison ---------------------------------------------------

def compare_runs(previous: DataFrame, current: DataFrame, score: str = "final_score_with_novelty") -> DataFrame:
    """What changed between two topic rankings (full outer join on topic)."""
    from pyspark.sql import Window
    w = Window.orderBy(F.desc(score), F.asc("topic"))   # topic tables: bounded by the topics
    p = previous.select("topic", F.col(score).alias("previous_score"),
                        F.row_number().over(w).alias("previous_rank"))
    c = current.select("topic", F.col(score).alias("current_score"),
                       F.row_number().over(w).alias("current_rank"))
    j = p.join(c, "topic", "full_outer")
    return j.select("topic", "previous_rank", "current_rank",
                    (F.col("previous_rank") - F.col("current_rank")).alias("rank_gain"),
                    (F.col("current_score") - F.col("previous_score")).alias("score_change"),
                    F.when(F.col("previous_rank").isNull(), "new")
                    .when(F.col("current_rank").isNull(), "dropped")
                    .when(F.col("previous_rank") > F.col("current_rank"), "up")
                    .when(F.col("previous_rank") < F.col("current_rank"), "down")
                    .otherwise("same").alias("movement"))
