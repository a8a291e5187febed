"""Registered queries: daily / weekly series, rolling windows, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.operators import forecast as FC
from tidewatch.operators import ridge as RG
from tidewatch.operators import series as S
from tidewatch.plans.fixture_sql import MENTIONS, MENTIONS_LONG, with_ctes
from tidewatch.plans.registry import register
from tidewatch.sources import tables

_DAILY = """,
daily AS (
  SELECT topic, CAST(date AS DATE) AS day, CAST(count(*) AS BIGINT) AS mentions,
         sum(coalesce(engagement, 0)) AS engagement
  FROM mentions WHERE topic IS NOT NULL AND date IS NOT NULL GROUP BY topic, CAST(date AS DATE)),
bounds AS (SELECT topic, min(day) AS d0, max(day) AS d1 FROM daily GROUP BY topic),
spine AS (
  SELECT topic, CAST(unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP),
                                            INTERVAL 1 DAY)) AS DATE) AS day
  FROM bounds),
filled AS (
  SELECT s.topic, s.day, CAST(coalesce(d.mentions, 0) AS DOUBLE) AS mentions,
         coalesce(d.engagement, 0.0) AS engagement
  FROM spine s LEFT JOIN daily d ON d.topic = s.topic AND d.day = s.day),
tl AS (
  SELECT topic, day, mentions,
         avg(mentions) OVER (PARTITION BY topic ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
           AS rolling_7d_mentions,
         avg(mentions) OVER (PARTITION BY topic ORDER BY day ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)
           AS rolling_21d_mentions
  FROM filled)"""

# Orders form a multi-year series: the same chain with orders as mentions.
_LONG_AS_MENTIONS = with_ctes(MENTIONS_LONG) + """,
mentions AS (SELECT topic, day AS date, engagement FROM mentions_long)"""

_WEEKLY = """,
weekly AS (
  SELECT topic, CAST(date_trunc('week', day) AS DATE) + 6 AS week_end, sum(mentions) AS mentions
  FROM filled GROUP BY 1, 2)"""


def _mentions(spark, sf_dir):
    return tables.mentions(spark, sf_dir)


def _long(spark, sf_dir):
    return tables.mentions_long(spark, sf_dir).withColumnRenamed("day", "date")


def _filled(records):
    return S.fill_daily(S.daily_series(records))


@register("a5_daily_series", with_ctes(MENTIONS) + _DAILY + """
SELECT topic, day, mentions, round(engagement, 6) AS engagement FROM daily""")
def a5_daily_series(spark, sf_dir):
    return S.daily_series(_mentions(spark, sf_dir))


@register("j5_f7_timeline", with_ctes(MENTIONS) + _DAILY + """
SELECT topic, day, mentions, round(rolling_7d_mentions, 6) AS rolling_7d_mentions,
       round(rolling_21d_mentions, 6) AS rolling_21d_mentions FROM tl""")
def j5_f7_timeline(spark, sf_dir):
    return S.timeline(_filled(_mentions(spark, sf_dir)))


@register("j5_f7_timeline_long", _LONG_AS_MENTIONS + _DAILY + """
SELECT topic, day, mentions, round(rolling_7d_mentions, 6) AS rolling_7d_mentions,
       round(rolling_21d_mentions, 6) AS rolling_21d_mentions FROM tl""")
def j5_f7_timeline_long(spark, sf_dir):
    """Gap-filled multi-year calendar (orders) with trailing means."""
    return S.timeline(_filled(_long(spark, sf_dir)))


_STATS = """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY day DESC) AS rn,
         count(*) OVER (PARTITION BY topic) AS n FROM tl)
SELECT topic, round(avg(CASE WHEN rn <= 7 THEN mentions END), 6) AS recent_daily_mean,
       round(max(CASE WHEN rn = 1 THEN rolling_7d_mentions END)
             - max(CASE WHEN rn = least(8, n) THEN rolling_7d_mentions END), 6) AS momentum_7d,
       round(greatest(avg(mentions), 1e-6), 6) AS baseline_daily_mean
FROM ranked GROUP BY topic"""


@register("w3_w4_series_stats", with_ctes(MENTIONS) + _DAILY + _STATS)
def w3_w4_series_stats(spark, sf_dir):
    return S.daily_stats(S.timeline(_filled(_mentions(spark, sf_dir))))


@register("w3_w4_series_stats_long", _LONG_AS_MENTIONS + _DAILY + _STATS)
def w3_w4_series_stats_long(spark, sf_dir):
    return S.daily_stats(S.timeline(_filled(_long(spark, sf_dir))))


@register("a6_weekly_series", _LONG_AS_MENTIONS + _DAILY + _WEEKLY + """
SELECT topic, week_end, round(mentions, 6) AS mentions FROM weekly""")
def a6_weekly_series(spark, sf_dir):
    return S.weekly_series(_filled(_long(spark, sf_dir)))


@register("w5_historical_4w", _LONG_AS_MENTIONS + _DAILY + _WEEKLY + """
SELECT topic, round(sum(CASE WHEN rn <= 4 THEN mentions ELSE 0 END), 6) AS historical_4w_mentions
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY week_end DESC) AS rn FROM weekly)
GROUP BY topic""")
def w5_historical_4w(spark, sf_dir):
    return S.historical_weeks(S.weekly_series(_filled(_long(spark, sf_dir))))


@register("f4_momentum_forecast", _LONG_AS_MENTIONS + _DAILY + _WEEKLY + """,
l2 AS (
  SELECT topic, max(CASE WHEN rn = 1 THEN mentions END) AS y1,
         coalesce(max(CASE WHEN rn = 1 THEN mentions END) - max(CASE WHEN rn = 2 THEN mentions END), 0) AS g
  FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY week_end DESC) AS rn FROM weekly)
  WHERE rn <= 2 GROUP BY topic)
SELECT topic, CAST(step AS BIGINT) AS step, round(greatest(0.0, y1 + step * g), 6) AS momentum_forecast
FROM l2, range(1, 9) t(step)""")
def f4_momentum_forecast(spark, sf_dir):
    return S.momentum_forecast(S.weekly_series(_filled(_long(spark, sf_dir))))


@register("f5_momentum_backtest", _LONG_AS_MENTIONS + _DAILY + _WEEKLY + """,
x AS (
  SELECT topic, mentions,
         row_number() OVER (PARTITION BY topic ORDER BY week_end) - 1 AS t,
         lag(mentions, 1) OVER (PARTITION BY topic ORDER BY week_end) AS p1,
         lag(mentions, 2) OVER (PARTITION BY topic ORDER BY week_end) AS p2
  FROM weekly)
SELECT topic, round(CASE WHEN count(*) < 5 THEN 1.0
                    ELSE avg(CASE WHEN t >= 3 THEN abs(mentions - greatest(0.0, 2 * p1 - p2)) END)
                    END, 6) AS momentum_mae
FROM x GROUP BY topic""")
def f5_momentum_backtest(spark, sf_dir):
    return S.momentum_backtest(S.weekly_series(_filled(_long(spark, sf_dir))))


# The ridge's evidence iteration as a recursive query over running sums of every prefix.
_RIDGE = """,
w0 AS (SELECT topic, week_end, mentions AS y, row_number() OVER (PARTITION BY topic ORDER BY week_end) - 1.0::DOUBLE AS t FROM weekly),
w1 AS (SELECT topic, t + 1 AS n, lead(y) OVER o AS nxt, sum(y) OVER o AS sy, sum(y * y) OVER o AS yy, sum(t * y) OVER o AS ty
       FROM w0 WINDOW o AS (PARTITION BY topic ORDER BY week_end)),
pre AS (SELECT topic, n, nxt, sy / n AS ym, (n - 1) / 2 AS xm, n * (n * n - 1) / 12 AS sxx, ty - (n - 1) / 2 * sy AS sxy,
               greatest(0.0, yy - sy * sy / n) AS syy FROM w1),
fit AS (
  SELECT *, 1.0 / (syy / n + 2.220446049250313e-16) AS alpha, 1.0::DOUBLE AS lam, NULL::DOUBLE AS prev, 0 AS it, false AS done FROM pre
  UNION ALL
  SELECT topic, n, nxt, ym, xm, sxx, sxy, syy,
         (n - gamma + 2e-6) / (greatest(0.0, syy - 2 * c * sxy + c * c * sxx) + 2e-6), (gamma + 2e-6) / (c * c + 2e-6),
         c, it + 1, coalesce(abs(prev - c) < 1e-3, false)
  FROM (SELECT *, CASE WHEN sxx > 0 THEN sxy / (sxx + lam / alpha) ELSE 0.0 END AS c,
               alpha * sxx / (lam + alpha * sxx) AS gamma FROM fit WHERE NOT done AND it < 300)),
ends AS (SELECT *, CASE WHEN sxx > 0 THEN sxy / (sxx + lam / alpha) ELSE 0.0 END AS slope
         FROM fit WHERE done OR it = 300),
ridge AS (SELECT topic, CAST(step AS BIGINT) AS step, greatest(0.0, ym - slope * xm + slope * (n - 1 + step)) AS forecast
          FROM ends, range(1, 9) r(step) WHERE nxt IS NULL),
ridge_mae AS (
  SELECT topic, CASE WHEN max(n) < 5 THEN 1.0
                ELSE avg(CASE WHEN n >= 3 THEN abs(nxt - greatest(0.0, ym - slope * xm + slope * n)) END) END AS mae
  FROM ends GROUP BY topic)"""

_MOMENTUM = """,
mx AS (SELECT topic, t, y, lag(y, 1) OVER o AS p1, lag(y, 2) OVER o AS p2, lead(y) OVER o AS nxt
       FROM w0 WINDOW o AS (PARTITION BY topic ORDER BY week_end)),
mom AS (SELECT topic, CAST(step AS BIGINT) AS step, greatest(0.0, y + step * coalesce(y - p1, 0)) AS forecast
        FROM mx, range(1, 9) r(step) WHERE nxt IS NULL),
mom_mae AS (SELECT topic, CASE WHEN count(*) < 5 THEN 1.0
                          ELSE avg(CASE WHEN t >= 3 THEN abs(y - greatest(0.0, 2 * p1 - p2)) END) END AS mae
            FROM mx GROUP BY topic)"""

_RECURSIVE = (_LONG_AS_MENTIONS + _DAILY + _WEEKLY).replace("WITH ", "WITH RECURSIVE ", 1) + _RIDGE


@register("f2_ridge_forecast", _RECURSIVE + """
SELECT topic, step, round(forecast, 6) AS forecast FROM ridge""")
def f2_ridge_forecast(spark, sf_dir):
    """Eight weeks of the Bayesian ridge trend per topic, over years of orders."""
    return RG.ridge_forecast(S.weekly_series(_filled(_long(spark, sf_dir))))


@register("f5_ridge_backtest", _RECURSIVE + """
SELECT topic, round(mae, 6) AS mae FROM ridge_mae""")
def f5_ridge_backtest(spark, sf_dir):
    """Mean one-step error of the ridge trend over all prefixes of each series."""
    return RG.ridge_backtest(S.weekly_series(_filled(_long(spark, sf_dir))))


@register("f1_ridge_momentum_forecast", _RECURSIVE + _MOMENTUM + """,
k AS (SELECT topic, 1.0 / greatest(r.mae, 1e-6) AS a, 1.0 / greatest(m.mae, 1e-6) AS b
      FROM ridge_mae r JOIN mom_mae m USING (topic))
SELECT topic, step, round((a * r.forecast + b * m.forecast) / (a + b), 6) AS forecast,
       round(a / (a + b), 6) AS ridge_weight, round(b / (a + b), 6) AS momentum_weight
FROM ridge r JOIN mom m USING (topic, step) JOIN k USING (topic)""")
def f1_ridge_momentum_forecast(spark, sf_dir):
    """The two closed-form models weighted by their backtests, step by step."""
    weekly = S.weekly_series(_filled(_long(spark, sf_dir))).checkpoint()
    momentum = S.momentum_forecast(weekly).withColumnRenamed("momentum_forecast", "forecast")
    error = S.momentum_backtest(weekly).withColumnRenamed("momentum_mae", "mae")
    return RG.weighted_forecast({"ridge": (RG.ridge_forecast(weekly), RG.ridge_backtest(weekly)),
                                 "momentum": (momentum, error)})


@register("f6_temporal_forecast")
def f6_temporal_forecast(spark, sf_dir):
    """Ensemble forecast summary per topic over the 30-day event stream."""
    _, summary = FC.temporal_forecast(_mentions(spark, sf_dir))
    return summary


@register("f6_temporal_forecast_long")
def f6_temporal_forecast_long(spark, sf_dir):
    """Ensemble forecast summary per topic over ~340 weeks of orders."""
    _, summary = FC.temporal_forecast(_long(spark, sf_dir))
    return summary


@register("f1_ensemble_weights_long")
def f1_ensemble_weights_long(spark, sf_dir):
    weekly = S.weekly_series(_filled(_long(spark, sf_dir)))
    return FC.ensemble_forecast(weekly).select(
        "topic", "n_weeks", "bayesian_weight", "holt_weight", "momentum_weight",
        F.col("forecast_8w_mentions"))
