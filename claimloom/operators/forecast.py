"""Trend and yearly season per series.

The model follows the published additive form (Taylor & Letham, "Forecasting at Scale", 2018): a
piecewise linear trend with change points in the first 80 % of the history and a yearly Fourier
season. The changes of slope have a Laplace prior, so that most are close to zero; the fit is the most likely
one, found by reweighted least squares without sampling, so equal input gives equal output.

The band has three parts: the noise, the uncertainty of the trend (with change points up to the end of
the history), and the change points still to come. These are taken to arrive as often as in the history, with
changes of the size that the series shows, so the variance they add to the trend grows with the cube of the
time ahead.

What scales with the data is the weekly aggregation in front (``series.weekly_series``). One group
here is one series of weeks, a few hundred rows whatever the number of invoices.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.config.schemas import FORECAST
from claimloom.functions.dates import weeks_to_year_end
from claimloom.operators.series import monthly_rollup, publish_forecast, weekly_series

# the functions below travel to the Python workers by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

YEAR = 365.25
CHANGE_POINTS = 25
FOURIER_PAIRS = 10
BAND = 1.2816  # 80 % of a normal distribution
CHANGE_SCALE = 0.05  # of the Laplace prior, with time and values scaled to one
SEASON_SCALE = 10.0
STEPS = 30
KNOWN_PART = 0.8  # of the history, in which change points are fitted


def _design(days: np.ndarray, scale: float, knots: np.ndarray, pairs: int) -> np.ndarray:
    t = days / scale
    angles = 2 * np.pi * np.outer(days, np.arange(1, pairs + 1)) / YEAR
    hinges = np.maximum(t[:, None] - knots[None, :], 0)
    return np.hstack([np.ones((len(t), 1)), t[:, None], hinges, np.sin(angles), np.cos(angles)])


def fit_trend(x: np.ndarray, y: np.ndarray, changes: int) -> tuple[np.ndarray, np.ndarray, float, float]:
    """The most likely coefficients of level, slope, changes and season, their covariance, the mean square of a
    change and the residual variance.

    |d| is bounded by d * d / (2 c) + c / 2, which is tight for c = |d|: each step is a least-squares fit. The
    scale of the changes and the noise are learned from the series: each step takes what the coefficients and
    their uncertainty say (expectation maximisation).
    """
    season = x.shape[1] - 2 - changes
    size, spread, noise = np.full(changes, CHANGE_SCALE), CHANGE_SCALE, max(float(np.var(y)), 1e-12)
    gram, moments = x.T @ x, x.T @ y
    free, wide = np.full(2, 1e-9), np.full(season, SEASON_SCALE**-2)
    for _ in range(STEPS):
        # of equally wide priors, for the uncertainty
        prior = np.concatenate([free, np.full(changes, 1 / (2 * spread**2)), wide])
        known = np.linalg.inv(gram / noise + np.diag(prior))
        mean = known @ moments / noise
        sparse = np.concatenate([free, 1 / (spread * np.maximum(size, 1e-4)), wide])
        beta = np.linalg.solve(gram + noise * np.diag(sparse), moments)
        size = np.abs(beta[2 : 2 + changes])
        square = mean[2 : 2 + changes] ** 2 + np.diag(known)[2 : 2 + changes]
        spread = max(float(np.sqrt(np.mean(square) / 2)) if changes else 0.0, 1e-4)
        noise = max((float(np.sum((y - x @ mean) ** 2)) + float(np.sum(known * gram))) / len(y), 1e-12)
    return beta, known, 2 * spread**2, noise


def fit_predict(days: np.ndarray, y: np.ndarray, ahead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prediction for the days ahead and its deviation on each; days count from the first point."""
    if len(y) < 2 or not np.any(y):
        return np.full(len(ahead), float(np.mean(y))), np.zeros(len(ahead))
    scale, top = float(days[-1]), float(np.abs(y).max())
    knots = np.linspace(0, KNOWN_PART, min(CHANGE_POINTS, len(y) // 3) + 1)[1:]
    pairs = min(FOURIER_PAIRS, len(y) // 8) if scale >= 2 * 365 else 0
    beta, *_ = fit_trend(_design(days, scale, knots, pairs), y / top, len(knots))
    # late changes are not fitted, but they may have come
    every = np.linspace(0, 1, round(len(knots) / KNOWN_PART) + 1)[1:]
    _, known, change, noise = fit_trend(_design(days, scale, every, pairs), y / top, len(every))
    trend = 2 + len(every)
    x = _design(ahead, scale, every, 0)
    # a change d at time s moves the trend by d * (t - s)
    to_come = len(every) * change * np.maximum(ahead / scale - 1, 0) ** 3 / 3
    return _design(ahead, scale, knots, pairs) @ beta * top, np.sqrt(noise + to_come + np.sum((x @ known[:trend, :trend]) * x, 1)) * top


def _forecast_series(series: pd.DataFrame) -> pd.DataFrame:
    series = series.sort_values("ds")
    start = pd.to_datetime(series["ds"])
    days = (start - start.iloc[0]).dt.days.to_numpy(float)
    periods = int(series["periods"].iloc[0])
    ahead = days[-1] + 7.0 * np.arange(1, periods + 1)
    yhat, spread = fit_predict(days, series["y"].to_numpy(float), ahead)
    return pd.DataFrame(
        {
            "region": series["region"].iloc[0],
            "ds": (start.iloc[0] + pd.to_timedelta(ahead, "D")).date,
            "yhat": yhat,
            "yhat_lower": yhat - BAND * spread,
            "yhat_upper": yhat + BAND * spread,
        }
    )


def forecast(series: DataFrame, horizon: DataFrame | None = None) -> DataFrame:
    """``(region, ds, yhat, yhat_lower, yhat_upper)`` for the weeks after each series.

    ``series`` is gap-filled ``(region, ds, y)``. Without ``horizon`` ``(region, periods)`` the
    forecast runs to the fiscal year end, found by a window so that the series is computed once.
    """
    points = series.select("region", "ds", F.col("y").cast("double").alias("y"))
    if horizon is None:
        last = F.max("ds").over(Window.partitionBy("region"))
        wanted = points.withColumn("periods", weeks_to_year_end(last))
    else:
        wanted = points.join(horizon.select("region", "periods"), "region")
    return wanted.filter("periods > 0").groupBy("region").applyInPandas(_forecast_series, FORECAST)


def forecast_regions(invoices: DataFrame, load_date: str, after: str | None = None) -> DataFrame:
    """From invoices ``(region, day, y)`` to published monthly rows, for all regions in one plan."""
    weeks = forecast(weekly_series(invoices, ["region"], "day", "y", after))
    return publish_forecast(monthly_rollup(weeks, ["region"]), "region", "yhat", load_date)
