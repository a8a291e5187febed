"""Bayesian ridge trend as column expressions (F2, F5) and the weighting of
several forecasts (F1), without Python workers.

Every prefix of a topic's weekly series is described by four running sums, so
the backtest fits all prefixes in one pass.  The evidence iteration is a fold
over a fixed number of steps on those sums.  The windows run over a topic's
weeks, whose number is bounded by the calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_STEPS = 300
TOLERANCE = 1e-3
PRIOR = 1e-6      # shape and rate of both gamma priors
EPSILON = 2.220446049250313e-16
FIRST_SPLIT = 3
LEAST_WEEKS = 5


def prefix_sums(weekly: DataFrame, value_col: str = "mentions") -> DataFrame:
    """(topic, n, y, next, ym, xm, sxx, sxy, syy) for the first n weeks of each topic;
    ``next`` is the week after them (null at the end)."""
    weeks = Window.partitionBy("topic").orderBy("week_end")
    upto = weeks.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = F.col(value_col).cast("double")
    w = weekly.select("topic", "week_end", y.alias("y")).withColumn("t", (F.row_number().over(weeks) - 1).cast("double"))
    w = w.select("topic", (F.col("t") + 1).alias("n"), "y", F.lead("y").over(weeks).alias("next"),
                 F.sum("y").over(upto).alias("_y"), F.sum(F.col("y") * F.col("y")).over(upto).alias("_yy"),
                 F.sum(F.col("t") * F.col("y")).over(upto).alias("_ty"))
    n, xm = F.col("n"), (F.col("n") - 1) / 2
    return w.select("topic", "n", "y", "next", (F.col("_y") / n).alias("ym"), xm.alias("xm"),
                    (n * (n * n - 1) / 12).alias("sxx"), (F.col("_ty") - xm * F.col("_y")).alias("sxy"),
                    F.greatest(F.lit(0.0), F.col("_yy") - F.col("_y") * F.col("_y") / n).alias("syy"))


def _slope(s):
    return F.when(F.col("sxx") > 0, F.col("sxy") / (F.col("sxx") + s["lam"] / s["alpha"])).otherwise(F.lit(0.0))


def _step(s, _):
    """One update of the precisions (alpha: noise, lam: slope)."""
    c = _slope(s)
    rss = F.greatest(F.lit(0.0), F.col("syy") - 2 * c * F.col("sxy") + c * c * F.col("sxx"))
    gamma = s["alpha"] * F.col("sxx") / (s["lam"] + s["alpha"] * F.col("sxx"))
    settled = s["prev"].isNotNull() & (F.abs(s["prev"] - c) < TOLERANCE)
    new = F.struct(((F.col("n") - gamma + 2 * PRIOR) / (rss + 2 * PRIOR)).alias("alpha"),
                   ((gamma + 2 * PRIOR) / (c * c + 2 * PRIOR)).alias("lam"), c.alias("prev"), settled.alias("done"))
    return F.when(s["done"], s).otherwise(new)


def fit(prefixes: DataFrame) -> DataFrame:
    """Adds ``slope`` and ``intercept`` to rows of ``prefix_sums``."""
    start = F.struct((1.0 / (F.col("syy") / F.col("n") + EPSILON)).alias("alpha"), F.lit(1.0).alias("lam"),
                     F.lit(None).cast("double").alias("prev"), F.lit(False).alias("done"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(MAX_STEPS)), start, _step)
    out = prefixes.withColumn("_end", end)
    return (out.withColumn("slope", _slope(F.col("_end")))
            .withColumn("intercept", F.col("ym") - F.col("slope") * F.col("xm")).drop("_end"))


def ridge_forecast(weekly: DataFrame, horizon: int = 8) -> DataFrame:
    """(topic, step, forecast) from the whole series, floored at 0."""
    whole = fit(prefix_sums(weekly).where("next IS NULL"))
    return (whole.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
            .select("topic", "step", F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * (F.col("n") - 1 + F.col("step")))
                    .alias("forecast")))


def ridge_backtest(weekly: DataFrame) -> DataFrame:
    """(topic, mae) of one-step forecasts from every prefix of at least
    ``FIRST_SPLIT`` weeks; 1.0 for series of fewer than ``LEAST_WEEKS``."""
    p = prefix_sums(weekly)
    sizes = p.groupBy("topic").agg(F.max("n").alias("weeks"))
    errors = (fit(p.where((F.col("n") >= FIRST_SPLIT) & F.col("next").isNotNull()))
              .groupBy("topic").agg(F.avg(F.abs(F.col("next") - F.greatest(
                  F.lit(0.0), F.col("intercept") + F.col("slope") * F.col("n")))).alias("_mae")))
    return (sizes.join(errors, "topic", "left")
            .select("topic", F.when(F.col("weeks") < LEAST_WEEKS, F.lit(1.0)).otherwise(F.col("_mae")).alias("mae")))


def weighted_forecast(parts: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """F1 over any models: ``parts`` maps a name to its (topic, step, forecast)
    and (topic, mae); each model weighs 1 / max(mae, 1e-6), shares add up to 1.
    Returns topic, step, forecast and a ``<name>_weight`` per model."""
    names = list(parts)
    rows = reduce(DataFrame.unionByName, [f.select("topic", "step", F.lit(k).alias("model"), "forecast")
                                          .join(m.select("topic", (1.0 / F.greatest("mae", F.lit(1e-6))).alias("w")), "topic")
                                          for k, (f, m) in parts.items()])
    total = F.sum("w")
    return rows.groupBy("topic", "step").agg(
        (F.sum(F.col("w") * F.col("forecast")) / total).alias("forecast"),
        *[(F.sum(F.when(F.col("model") == k, F.col("w"))) / total).alias(f"{k}_weight") for k in names])
