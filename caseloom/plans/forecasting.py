"""The decomposition forecast of every series, from raw weekly values to the export table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators import timeseries as ts
from caseloom.operators.arma import classified
from caseloom.operators.clean import cap_outliers
from caseloom.session import materialize

# Names of the exported columns.
EXPORT_NAMES = {"y_prediction": "predicted_y_value", "y": "actual_y_value"}


def decompose(
    df: DataFrame,
    series: str,
    date: str,
    value: str,
    exo: str,
    external: DataFrame,
    end: Column,
    cap: float | None = None,
    lifted: Sequence[str] = (),
    change: Column | None = None,
    change_end: Column | None = None,
    season: int = 52,
    smooth: int = 10,
    val_share: float = 0.2,
    shift_days: int | None = None,
) -> DataFrame:
    """Trend, predicted trend, seasonality and residual of each series, on its own and the external dates.

    ``lifted`` names the series whose level changed at ``change`` and is to be adjusted.
    """
    grid = materialize(df, "grid")  # the raw table is read once
    clean = ts.fill_weeks(grid, series, date, [value], end)
    if cap is not None:
        clean = cap_outliers(clean, value, cap)
    if lifted:
        clean = ts.adjust_baseline(clean, series, date, value, change, change_end, only=lifted)
    with_trend = ts.trend(clean, series, date, value, season)
    combined = ts.add_regressor(with_trend, series, date, external.select(date, exo), shift_days, members=grid)
    fitted = ts.trend_regression(combined, series, date, "trend", exo, val_share)
    seasonal = ts.seasonality(fitted, series, date, value, "trend", smooth)
    return ts.residual(seasonal, value, "trend", "seasonality")


def forecast_all(
    parts: DataFrame, series: str, date: str, val_share: float = 0.2, steps: int = 5, p: int = 3, q: int = 3, clamp: bool = False,
    exo: list[str] | None = None, models: DataFrame | None = None,
) -> DataFrame:
    """Residual predictions joined to the decomposition, and the total prediction on test and forecast rows.

    ``exo`` names regressor columns of ``parts``, whose rows after the last residual hold them for the forecast; ``models``
    are stored models of the residual, then nothing is fitted.
    """
    stored = materialize(parts, "decomposition")
    usable = stored.dropna("any", subset=["residual", "predicted_trend"])
    later = stored.where("residual IS NULL").dropna("any", subset=exo) if exo else None
    results = classified(usable, series, date, "residual", val_share, steps, p, q, clamp, exo, later, models)
    joined = stored.join(results.select(series, date, F.col("predicted").alias("predicted_residual"), "classification"), [series, date], "left")
    return ts.total_prediction(joined, "predicted_trend", "seasonality", "predicted_residual", "classification")


def export_frame(df: DataFrame, series: str, date: str, value: str, names: Mapping[str, str] = EXPORT_NAMES) -> DataFrame:
    """Columns to publish: series, date, actual and predicted value, classification."""
    kept = df.select(series, date, F.col(value).alias("y"), "y_prediction", "classification")
    return kept.withColumnsRenamed(dict(names))
