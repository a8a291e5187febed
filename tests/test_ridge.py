"""The ridge as column expressions against the plain numeric model."""

import datetime as dt

import numpy as np
import pytest

from tidewatch.operators import forecast as FC
from tidewatch.operators import ridge as RG

SERIES = {
    "up": [3, 5, 4, 8, 9, 12, 11, 15, 14, 18],
    "flat": [4] * 8,
    "line": [2, 4, 6, 8, 10],
    "one": [7],
    "four": [1, 9, 2, 8],
    "falls": [50, 30, 20, 4, 1, 0, 0],
    "noise": list(np.random.default_rng(1).integers(0, 900, 60)),
}


@pytest.fixture(scope="module")
def weekly(spark):
    rows = [(k, dt.date(2024, 1, 7) + dt.timedelta(weeks=i), float(v)) for k, y in SERIES.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "topic string, week_end date, mentions double")


def test_forecast_matches_the_numeric_model(weekly):
    got = {}
    for r in RG.ridge_forecast(weekly).collect():
        got.setdefault(r["topic"], {})[r["step"]] = r["forecast"]
    for k, y in SERIES.items():
        want = FC.bayes_forecast(np.array(y, dtype=float), 8)
        assert [got[k][s] for s in range(1, 9)] == pytest.approx(list(want), abs=1e-5), k


def test_backtest_matches_the_numeric_model(weekly):
    got = {r["topic"]: r["mae"] for r in RG.ridge_backtest(weekly).collect()}
    assert got == {k: pytest.approx(FC.backtest_mae(np.array(y, dtype=float), "bayesian"), abs=1e-5) for k, y in SERIES.items()}


def test_weights_add_up(spark, weekly):
    part = (RG.ridge_forecast(weekly), RG.ridge_backtest(weekly))
    out = RG.weighted_forecast({"a": part, "b": part}).collect()
    assert len(out) == 8 * len(SERIES) and all(r["a_weight"] == pytest.approx(0.5) for r in out)


def test_no_series(spark):
    empty = spark.createDataFrame([], "topic string, week_end date, mentions double")
    assert RG.ridge_forecast(empty).count() == 0 and RG.ridge_backtest(empty).count() == 0
