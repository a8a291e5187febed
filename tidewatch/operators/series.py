"""Daily / weekly topic series.

Records are aggregated to (topic, day) first with a map-side combine, so every
later step works on a table whose size is bounded by topics x calendar days and
does not grow with the number of mentions.  Windows partitioned by topic then
hold one topic's calendar (a few thousand rows at most), not its records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHORT_WINDOW = 7
LONG_WINDOW = 21
MOMENTUM_LOOKBACK = 8
RECENT_DAYS = 7
HISTORY_WEEKS = 4


def daily_series(records: DataFrame, day_col: str = "date", value_col: str = "engagement") -> DataFrame:
    """A5: mentions and engagement per (topic, day); null days / topics excluded."""
    return (records.where(F.col("topic").isNotNull() & F.col(day_col).isNotNull())
            .groupBy("topic", F.col(day_col).cast("date").alias("day"))
            .agg(F.count(F.lit(1)).alias("mentions"),
                 F.sum(F.coalesce(F.col(value_col).cast("double"), F.lit(0.0))).alias("engagement")))


def fill_daily(daily: DataFrame) -> DataFrame:
    """Per-topic calendar from first to last day, missing days -> 0 mentions.

    The (topic, day) table is checkpointed: it feeds both the bounds and the
    join, and must not re-run the record aggregation twice.
    """
    daily = daily.checkpoint()
    bounds = daily.groupBy("topic").agg(F.min("day").alias("_d0"), F.max("day").alias("_d1"))
    spine = bounds.select("topic", F.explode(
        F.sequence(F.col("_d0"), F.col("_d1"), F.expr("INTERVAL 1 DAY"))).alias("day"))
    return (spine.join(daily, ["topic", "day"], "left")
            .select("topic", "day",
                    F.coalesce(F.col("mentions"), F.lit(0)).cast("double").alias("mentions"),
                    F.coalesce(F.col("engagement"), F.lit(0.0)).alias("engagement")))


def timeline(filled: DataFrame) -> DataFrame:
    """F7 + W2: trailing 7- and 21-day means (partial windows at the start)."""
    w = Window.partitionBy("topic").orderBy("day")
    return filled.select(
        "topic", "day", "mentions",
        F.avg("mentions").over(w.rowsBetween(-(SHORT_WINDOW - 1), 0)).alias("rolling_7d_mentions"),
        F.avg("mentions").over(w.rowsBetween(-(LONG_WINDOW - 1), 0)).alias("rolling_21d_mentions"))


def daily_stats(tl: DataFrame) -> DataFrame:
    """W3 / W4 per topic: recent mean, 7-day momentum, baseline level.

    Momentum compares the last 7-day mean with the one at position
    max(0, n - 8), i.e. rank min(8, n) counted from the end.
    """
    w_desc = Window.partitionBy("topic").orderBy(F.desc("day"))
    ranked = (tl.withColumn("_rn", F.row_number().over(w_desc))
              .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("topic"))))
    ref = F.least(F.lit(MOMENTUM_LOOKBACK), F.col("_n"))
    return (ranked.groupBy("topic").agg(
        F.avg(F.when(F.col("_rn") <= RECENT_DAYS, F.col("mentions"))).alias("recent_daily_mean"),
        (F.max(F.when(F.col("_rn") == 1, F.col("rolling_7d_mentions")))
         - F.max(F.when(F.col("_rn") == ref, F.col("rolling_7d_mentions")))).alias("momentum_7d"),
        F.greatest(F.avg("mentions"), F.lit(1e-6)).alias("baseline_daily_mean")))


def weekly_series(filled: DataFrame, value_col: str = "mentions") -> DataFrame:
    """Sums per Monday..Sunday week, labelled by its Sunday; partial weeks kept."""
    return (filled.groupBy("topic", F.date_add(F.trunc("day", "week"), 6).alias("week_end"))
            .agg(F.sum(value_col).alias(value_col)))



def historical_weeks(weekly: DataFrame, value_col: str = "mentions", k: int = HISTORY_WEEKS) -> DataFrame:
    """Sum of the last (up to) k weeks per topic."""
    w = Window.partitionBy("topic").orderBy(F.desc("week_end"))
    return (weekly.withColumn("_rn", F.row_number().over(w))
            .groupBy("topic")
            .agg(F.sum(F.when(F.col("_rn") <= k, F.col(value_col)).otherwise(0.0))
                 .alias("historical_4w_mentions")))


def momentum_forecast(weekly: DataFrame, horizon: int = 8, value_col: str = "mentions") -> DataFrame:
    """y[-1] + k * (y[-1] - y[-2]) for k = 1..horizon, floored at 0 (0 growth if < 2 points)."""
    w = Window.partitionBy("topic").orderBy(F.desc("week_end"))
    last2 = (weekly.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= 2)
             .groupBy("topic")
             .agg(F.max(F.when(F.col("_rn") == 1, F.col(value_col))).alias("_y1"),
                  F.max(F.when(F.col("_rn") == 2, F.col(value_col))).alias("_y2")))
    growth = F.coalesce(F.col("_y1") - F.col("_y2"), F.lit(0.0))
    return (last2.select("topic", "_y1", growth.alias("_g"),
                         F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
            .select("topic", "step",
                    F.greatest(F.lit(0.0), F.col("_y1") + F.col("step") * F.col("_g"))
                    .alias("momentum_forecast")))


def momentum_backtest(weekly: DataFrame, value_col: str = "mentions") -> DataFrame:
    """F5 for the momentum model: MAE of one-step forecasts for splits 3..n-1; n < 5 -> 1.0."""
    w = Window.partitionBy("topic").orderBy("week_end")
    x = (weekly.withColumn("_t", F.row_number().over(w) - 1)
         .withColumn("_p1", F.lag(value_col, 1).over(w))
         .withColumn("_p2", F.lag(value_col, 2).over(w)))
    err = F.abs(F.col(value_col) - F.greatest(F.lit(0.0), 2 * F.col("_p1") - F.col("_p2")))
    return (x.groupBy("topic")
            .agg(F.count(F.lit(1)).alias("_n"), F.avg(F.when(F.col("_t") >= 3, err)).alias("_mae"))
            .select("topic", F.when(F.col("_n") < 5, F.lit(1.0)).otherwise(F.col("_mae"))
                    .alias("momentum_mae")))
