"""Additive forecasts: piecewise-linear trend plus yearly and weekly Fourier terms, per series.

Only the fit runs in Python, on one bounded array per series; it returns a few coefficients. Dates, components and
intervals are Spark expressions over those coefficients.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.arma import as_arrays

YEARLY_ORDER, YEAR_DAYS = 10, 365.25
WEEKLY_ORDER, WEEK_DAYS = 3, 7.0
CHANGEPOINTS, CHANGEPOINT_RANGE = 25, 0.8
CHANGEPOINT_SCALE, SEASON_SCALE = 0.05, 10.0
INTERVAL_Z = 1.2815515655446004  # 80 %

FIT_SCHEMA = (
    "struct<start:double,span:double,scale:double,level:double,slope:double,points:array<double>,"
    "bends:array<double>,yearly:array<double>,weekly:array<double>,sigma:double>"
)


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    angles = 2.0 * np.pi * np.outer(days, np.arange(1, order + 1)) / period
    return np.hstack([np.sin(angles), np.cos(angles)])


def fit_additive(days: np.ndarray, y: np.ndarray) -> dict:
    """Ridge fit in scaled units; the penalties are the noise variance over the squared prior scales."""
    span = max(days[-1] - days[0], 1.0)
    t = (days - days[0]) / span
    scale = float(np.abs(y).max()) or 1.0
    inner = int(len(days) * CHANGEPOINT_RANGE)
    count = max(min(CHANGEPOINTS, inner - 1), 0)
    points = t[np.linspace(0, inner - 1, count + 1).round().astype(int)[1:]] if count else np.empty(0)
    yearly = YEARLY_ORDER if span >= 2 * 365 else 0
    weekly = WEEKLY_ORDER if span >= 2 * WEEK_DAYS else 0
    design = np.hstack([
        np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - points, 0.0),
        _fourier(days, YEAR_DAYS, yearly), _fourier(days, WEEK_DAYS, weekly),
    ])
    prior = np.concatenate([
        [np.inf, np.inf], np.full(count, CHANGEPOINT_SCALE), np.full(2 * (yearly + weekly), SEASON_SCALE)
    ])
    target, noise = y / scale, 0.01
    for _ in range(3):
        gram = design.T @ design + np.diag(noise / prior**2 + 1e-9)
        beta = np.linalg.solve(gram, design.T @ target)
        noise = float(np.mean((target - design @ beta) ** 2)) or 1e-9
    beta = beta * scale
    cut = np.cumsum([2, count, 2 * yearly])
    return {
        "start": float(days[0]), "span": float(span), "scale": scale, "level": float(beta[0]), "slope": float(beta[1]),
        "points": points.tolist(), "bends": beta[2 : cut[1]].tolist(), "yearly": beta[cut[1] : cut[2]].tolist(),
        "weekly": beta[cut[2] :].tolist(), "sigma": float(np.sqrt(noise)) * scale,
    }


def future_dates(df: DataFrame, series: str, date: str, periods: int) -> DataFrame:
    """The history dates of each series and ``periods`` daily steps after the last one."""
    last = df.groupBy(series).agg(F.max(date).alias("__last"))
    day = F.expr("interval 1 day")
    ahead = F.sequence(F.col("__last") + day, F.col("__last") + F.make_dt_interval(days=F.lit(periods)), day)
    return df.select(series, date).distinct().unionByName(last.select(series, F.explode(ahead).alias(date)))


def fit(df: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """One row of coefficients per series, from daily sums of the value."""

    @F.pandas_udf(FIT_SCHEMA)
    def coefficients(ds: pd.Series, ys: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fit_additive(np.asarray(d, dtype=float), np.asarray(y, dtype=float)) for d, y in zip(ds, ys)])

    daily = df.groupBy(series, F.unix_date(F.col(date).cast("date")).cast("double").alias("__day")).agg(F.sum(value).alias("__y"))
    arrays = as_arrays(daily, series, "__day", "__y").repartition(series)
    return arrays.select(series, coefficients("ds", "ys").alias("model"))


def _season(weights: Column, day: Column, period: float) -> Column:
    """Sum of weighted sines (first half of the weights) and cosines (second half)."""
    half = F.size(weights) / 2

    def term(w: Column, i: Column) -> Column:
        k = F.when(i < half, i + 1).otherwise(i + 1 - half)
        angle = k * day * (2.0 * np.pi / period)
        return w * F.when(i < half, F.sin(angle)).otherwise(F.cos(angle))

    return F.aggregate(F.transform(weights, term), F.lit(0.0), lambda a, x: a + x)


def components(frame: DataFrame, models: DataFrame, series: str, date: str) -> DataFrame:
    """Trend, yearly and weekly part of each date as columns, with the model's noise level."""
    day = F.unix_date(F.col(date).cast("date")).cast("double")
    t = (day - F.col("model.start")) / F.col("model.span")
    bends = F.zip_with("model.points", "model.bends", lambda c, b: b * F.greatest(t - c, F.lit(0.0)))
    trend = F.col("model.level") + F.col("model.slope") * t + F.aggregate(bends, F.lit(0.0), lambda a, x: a + x)
    return frame.join(models, series).select(
        series, date, trend.alias("trend"), _season(F.col("model.yearly"), day, YEAR_DAYS).alias("yearly"),
        _season(F.col("model.weekly"), day, WEEK_DAYS).alias("weekly"), F.col("model.sigma").alias("sigma"),
    )


def predict(parts: DataFrame, series: str, date: str) -> DataFrame:
    """Forecast with its 80 % interval from component columns."""
    yhat = F.col("trend") + F.col("yearly") + F.col("weekly")
    margin = F.col("sigma") * INTERVAL_Z
    return parts.select(series, date, yhat.alias("yhat"), (yhat - margin).alias("yhat_lower"), (yhat + margin).alias("yhat_upper"))


def long_components(parts: DataFrame, series: str, date: str) -> DataFrame:
    """Component table ``(series, date, component, value)``."""
    return parts.unpivot([series, date], ["trend", "yearly", "weekly"], "component", "value")
