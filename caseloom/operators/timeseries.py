"""Decomposition of time series into trend, seasonality and residual, for all series at once.

Every frame holds one row per series and grid date, so a series has at most as many rows as the calendar has grid
dates (5,218 weeks per century). Windows partitioned by series are bounded by that, whatever the size of the raw
table; the raw rows are summed to the grid first, with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.dates import add_days, first_sunday, iso_week
from caseloom.operators.ordered import rolling_mean
from caseloom.operators.relational import append_rows, combine_first


def grid_sum(df: DataFrame, series: Sequence[str], date: Column, value: Column, date_name: str, name: str) -> DataFrame:
    """Raw rows summed to one row per series and grid date."""
    return df.groupBy(*series, date.alias(date_name)).agg(F.sum(value).alias(name))


def fill_weeks(df: DataFrame, series: str, date: str, values: Sequence[str], end: Column) -> DataFrame:
    """Weekly grid from each series' first date to ``end``; absent weeks are 0, rows off the grid are dropped.

    The frame is read twice (first dates, values): materialise it when it is costly to compute.
    """
    span = df.groupBy(series).agg(F.min(date).alias("__start")).where(F.col("__start") <= end)
    grid = span.select(series, F.explode(F.sequence("__start", end, F.expr("interval 7 days"))).alias(date))
    found = df.select(series, date, *values, F.lit(True).alias("__found"))
    return grid.join(found, [series, date], "left").select(
        series, date, *[F.when(F.col("__found"), F.col(v)).otherwise(F.lit(0)).alias(v) for v in values]
    )


def resample_weekly(df: DataFrame, series: Sequence[str], date: str, values: Sequence[str]) -> DataFrame:
    """Forward fill to weeks that end on Sunday, from the first Sunday on or after the first date to that of the last.

    Each source row is expanded to the Sundays it covers, so no as-of join is needed.
    """
    following = F.lead(date).over(Window.partitionBy(*series).orderBy(date))
    own = first_sunday(date)
    last = F.when(following.isNull(), own).otherwise(first_sunday(following) - F.expr("interval 7 days"))
    covered = df.withColumn("__last", last).where(F.col("__last") >= own)
    weeks = F.explode(F.sequence(own, F.col("__last"), F.expr("interval 7 days"))).alias("__week")
    return covered.select(*series, weeks, *values).select(*series, F.col("__week").alias(date), *values)


def regressor(
    level: DataFrame,
    share: DataFrame,
    date: str,
    level_value: str,
    share_value: str,
    name: str,
    future_level: Sequence[dict] = (),
    future_share: Sequence[dict] = (),
    window: int = 12,
) -> DataFrame:
    """Weekly external regressor: level times percentage share, joined on date, weekly (4/52), smoothed."""
    levels = append_rows(level.select(date, level_value), future_level)
    shares = append_rows(share.select(date, share_value), future_share)
    product = levels.join(shares, date, "left").select(date, (F.col(level_value) * (F.col(share_value) / 100.0)).alias(name))
    weekly = resample_weekly(product, [], date, [name]).withColumn(name, F.col(name) * 4 / 52)
    smooth = rolling_mean(weekly, name, date, window, min_periods=1, name="__smooth", bounded=True)
    return smooth.select(date, F.col("__smooth").alias(name))


def adjust_baseline(
    df: DataFrame, series: str, date: str, value: str, change: Column, end: Column, only: Sequence[str] | None = None
) -> DataFrame:
    """Lift rows up to ``change`` by (mean of (change, end] minus mean up to change) of their series.

    ``only`` names the series to lift (default: all).
    """
    window = Window.partitionBy(series)
    before = F.avg(F.when(F.col(date) <= change, F.col(value))).over(window)
    after = F.avg(F.when((F.col(date) > change) & (F.col(date) <= end), F.col(value))).over(window)
    lifted = F.col(date) <= change
    if only is not None:
        lifted = lifted & F.col(series).isin(list(only))
    return df.withColumn(value, F.when(lifted, F.col(value) + (after - before)).otherwise(F.col(value)))


def trend(df: DataFrame, series: str, date: str, value: str, season: int = 52, center: bool = False, name: str = "trend") -> DataFrame:
    return rolling_mean(df, value, date, season, [series], center=center, name=name, bounded=True)


def add_regressor(
    df: DataFrame, series: str, date: str, external: DataFrame, shift_days: int | None = None, members: DataFrame | None = None
) -> DataFrame:
    """Outer union of each series with the external weeks; shared columns keep the series' value.

    The external frame has one row per week, so it travels as one array bounded by the calendar. ``members`` lists the
    series when that is cheaper to read elsewhere than from ``df``.
    """
    weeks = external if shift_days is None else external.withColumn(date, add_days(date, shift_days))
    calendar = weeks.agg(F.collect_list(F.struct(*weeks.columns))).scalar()
    per_series = (df if members is None else members).select(series).distinct().select(series, F.inline(calendar))
    return combine_first(df, per_series, [series, date])


def trend_regression(
    df: DataFrame, series: str, date: str, trend_col: str, exo_col: str, val_share: float = 0.2, name: str = "predicted_trend"
) -> DataFrame:
    """Straight line of trend on regressor per series, fitted on the first complete rows, applied wherever the regressor is known."""
    complete = F.lit(True)
    for c in df.columns:
        complete = complete & F.col(f"`{c}`").isNotNull()
    by_series = Window.partitionBy(series)
    up_to = by_series.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("__ok", complete)
    counted = marked.withColumns({
        "__rank": F.count_if("__ok").over(up_to),
        "__size": F.floor(F.count_if("__ok").over(by_series) * (1 - val_share)),
    })
    train = F.col("__ok") & (F.col("__rank") <= F.col("__size"))
    y, x = F.when(train, F.col(trend_col)), F.when(train, F.col(exo_col))
    fitted = counted.withColumns({
        "__slope": F.regr_slope(y, x).over(by_series),
        "__intercept": F.regr_intercept(y, x).over(by_series),
    })
    return fitted.withColumn(name, F.col("__intercept") + F.col("__slope") * F.col(exo_col)).select(*df.columns, name)


def seasonality(
    df: DataFrame, series: str, date: str, value: str, trend_col: str, window: int = 10, name: str = "seasonality"
) -> DataFrame:
    """Smoothed value minus trend, averaged per ISO week of the year, given to every date of that week."""
    detrended = df.withColumn("__gap", F.col(value) - F.col(trend_col))
    smooth = rolling_mean(detrended, "__gap", date, window, [series], center=True, name="__smooth", bounded=True)
    by_week = Window.partitionBy(series, iso_week(date))
    return smooth.withColumn(name, F.avg("__smooth").over(by_week)).select(*df.columns, name)


def residual(df: DataFrame, value: str, trend_col: str, seasonality_col: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.col(trend_col) - F.col(seasonality_col))


def autocorrelation(df: DataFrame, series: str, date: str, value: str, lags: int = 25) -> DataFrame:
    """Sample autocorrelation for lags 0..n of each series' non-null values."""
    known = df.where(F.col(value).isNotNull())
    by_series = Window.partitionBy(series)
    centred = known.withColumn("__x", F.col(value) - F.avg(value).over(by_series))
    ordered = by_series.orderBy(date)
    products = [F.col("__x") * F.lag("__x", k).over(ordered) for k in range(lags + 1)]
    wide = centred.select(series, F.array(*products).alias("__ps")).select(series, F.posexplode("__ps").alias("lag", "__p"))
    sums = wide.groupBy(series, "lag").agg(F.coalesce(F.sum("__p"), F.lit(0.0)).alias("__s"))
    total = F.max(F.when(F.col("lag") == 0, F.col("__s"))).over(by_series)
    return sums.select(series, "lag", F.try_divide(F.col("__s"), total).alias("acf"))


def total_prediction(
    df: DataFrame, trend_col: str, seasonality_col: str, residual_col: str, class_col: str, name: str = "y_prediction"
) -> DataFrame:
    """Trend plus seasonality plus residual on test and forecast rows; null if any part is."""
    total = F.col(trend_col) + F.col(seasonality_col) + F.col(residual_col)
    return df.withColumn(name, F.when(F.col(class_col).isin("test", "forecast"), total))
