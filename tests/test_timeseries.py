import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseloom.functions.dates import first_sunday, parse_month_first
from caseloom.operators import additive, arma
from caseloom.operators import timeseries as ts
from caseloom.operators.relational import combine_first, fill_from_prior_period


def day(text):
    return dt.datetime.strptime(text, "%Y-%m-%d")


def moment(text):
    return F.lit(text).cast("timestamp_ntz")


def weekly(spark, values, start="2020-01-06", series="s"):
    data = [(series, day(start) + dt.timedelta(days=7 * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "series string, week timestamp_ntz, y double")


def column(df, name, order="week"):
    return [r[name] for r in df.orderBy(order).collect()]


def test_fill_weeks_gaps_nulls_and_off_grid(spark):
    data = [("a", day("2020-01-06"), 1.0), ("a", day("2020-01-21"), 5.0), ("a", day("2020-01-27"), None), ("b", day("2020-01-20"), 2.0),
            ("late", day("2020-03-01"), 1.0)]
    df = spark.createDataFrame(data, "series string, week timestamp_ntz, y double")
    got = rows(ts.fill_weeks(df, "series", "week", ["y"], moment("2020-02-03")))
    assert got == sorted([
        ("a", day("2020-01-06"), 1.0), ("a", day("2020-01-13"), 0.0), ("a", day("2020-01-20"), 0.0), ("a", day("2020-01-27"), None),
        ("a", day("2020-02-03"), 0.0), ("b", day("2020-01-20"), 2.0), ("b", day("2020-01-27"), 0.0), ("b", day("2020-02-03"), 0.0),
    ], key=repr)


def test_resample_weekly_matches_pandas(spark):
    quarters = ["2020-01-01", "2020-04-01", "2020-07-01"]
    df = spark.createDataFrame([(day(q), float(i)) for i, q in enumerate(quarters)], "d timestamp_ntz, v double")
    got = [(r.d, r.v) for r in ts.resample_weekly(df, [], "d", ["v"]).orderBy("d").collect()]
    want = pd.Series([0.0, 1.0, 2.0], pd.to_datetime(quarters)).resample("W").ffill()
    assert got == [(k.to_pydatetime(), v) for k, v in want.items()]
    assert len(got) == 27 and got[0][0] == day("2020-01-05") and got[-1][0] == day("2020-07-05")


def test_resample_with_two_points_in_one_week(spark):
    df = spark.createDataFrame([(day("2020-01-01"), 1.0), (day("2020-01-03"), 2.0), (day("2020-01-12"), 3.0)], "d timestamp_ntz, v double")
    assert set(rows(ts.resample_weekly(df, [], "d", ["v"]))) == {(day("2020-01-05"), 2.0), (day("2020-01-12"), 3.0)}


def test_first_sunday(spark):
    df = spark.createDataFrame([(day("2020-01-05"),), (day("2020-01-06"),), (day("2020-01-11"),)], "d timestamp_ntz")
    assert [r[0] for r in df.select(first_sunday("d")).collect()] == [day("2020-01-05"), day("2020-01-12"), day("2020-01-12")]


@pytest.mark.parametrize("n", [1, 51, 52, 60])
def test_trend_needs_a_full_season(spark, n):
    df = weekly(spark, range(n))
    got = column(ts.trend(df, "series", "week", "y"), "trend")
    want = pd.Series(range(n), dtype=float).rolling(52).mean()
    assert [None if pd.isna(w) else w for w in want] == got


def test_parts_sum_to_the_value(spark):
    rng = np.random.default_rng(3)
    df = weekly(spark, rng.integers(0, 100, 150))
    parts = ts.residual(ts.seasonality(ts.trend(df, "series", "week", "y"), "series", "week", "y", "trend"), "y", "trend", "seasonality")
    checked = [r for r in parts.collect() if r.residual is not None]
    assert checked and all(abs(r.trend + r.seasonality + r.residual - r.y) < 1e-9 for r in checked)


def test_seasonality_matches_pandas(spark):
    rng = np.random.default_rng(5)
    values = rng.integers(0, 100, 160).astype(float)
    df = weekly(spark, values)
    got = column(ts.seasonality(ts.trend(df, "series", "week", "y"), "series", "week", "y", "trend"), "seasonality")
    index = pd.DatetimeIndex([day("2020-01-06") + dt.timedelta(days=7 * i) for i in range(160)])
    y = pd.Series(values, index)
    smooth = (y - y.rolling(52).mean()).rolling(10, center=True).mean()
    by_week = smooth.groupby(index.isocalendar().week.to_numpy()).mean()
    want = [by_week[w] for w in index.isocalendar().week]
    assert np.allclose(np.array(got, dtype=float), np.array(want), equal_nan=True)


def test_adjust_baseline(spark):
    df = weekly(spark, [1, 1, 5, 5, 100])
    lifted = ts.adjust_baseline(df, "series", "week", "y", moment("2020-01-13"), moment("2020-01-27"))
    assert column(lifted, "y") == [5.0, 5.0, 5.0, 5.0, 100.0]


def test_trend_regression_is_row_aligned(spark):
    df = weekly(spark, [None] * 4).withColumn("exo", F.lit(1.0))
    data = [("s", day("2020-01-06") + dt.timedelta(days=7 * i), 3.0 * i + 1 if i < 8 else None, float(i) if i != 9 else None) for i in range(11)]
    df = spark.createDataFrame(data, "series string, week timestamp_ntz, trend double, exo double")
    got = column(ts.trend_regression(df, "series", "week", "trend", "exo"), "predicted_trend")
    assert got[9] is None
    assert np.allclose([g for g in got if g is not None], [3.0 * i + 1 for i in range(11) if i != 9])


def test_combine_first_equals_pandas(spark):
    left = pd.DataFrame({"k": [1, 2, 3], "x": [1.0, None, 3.0], "l": [7.0, 8.0, 9.0]})
    right = pd.DataFrame({"k": [2, 3, 4], "x": [20.0, 30.0, 40.0], "r": [5.0, None, 6.0]})
    got = combine_first(spark.createDataFrame(left), spark.createDataFrame(right), ["k"]).toPandas().sort_values("k").set_index("k")
    want = left.set_index("k").combine_first(right.set_index("k"))
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)], check_names=False)


def test_prior_period_is_one_pass(spark):
    df = weekly(spark, [1, None, None])
    assert column(fill_from_prior_period(df, "y", "week", 7, ["series"]), "y") == [1.0, 1.0, None]


def test_regressor_joins_on_dates(spark):
    level = spark.createDataFrame([(day("2020-01-01"), 100.0), (day("2020-04-01"), 200.0)], "d timestamp_ntz, gdp double")
    share = spark.createDataFrame([(day("2020-04-01"), 10.0), (day("2020-01-01"), 50.0)], "d timestamp_ntz, perc double")
    out = ts.regressor(level, share, "d", "gdp", "perc", "exo", [{"d": day("2020-07-01"), "gdp": 300.0}], [{"d": day("2020-07-01"), "perc": 10.0}])
    got = column(out, "exo", "d")
    weeks = pd.Series([50.0, 20.0, 30.0], pd.to_datetime(["2020-01-01", "2020-04-01", "2020-07-01"])).resample("W").ffill() * 4 / 52
    assert np.allclose(got, weeks.rolling(12, min_periods=1).mean())


def test_month_first_dates(spark):
    df = spark.createDataFrame([("7/1/2020",), ("12/31/2020",), ("x",)], "s string")
    assert [r[0] for r in df.select(parse_month_first("s")).collect()] == [day("2020-07-01"), day("2020-12-31"), None]


# ARMA


def arma_path(ar, ma, n=4000, seed=11):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 100)
    x = np.zeros(n + 100)
    for t in range(5, n + 100):
        x[t] = sum(a * x[t - i - 1] for i, a in enumerate(ar)) + e[t] + sum(b * e[t - i - 1] for i, b in enumerate(ma))
    return x[100:]


@pytest.mark.parametrize("ar,ma", [((0.6, -0.3), ()), ((), (0.5, 0.2)), ((0.5,), (0.4,))])
def test_coefficients_are_recovered(ar, ma):
    fit = arma.fit_arma(arma_path(ar, ma) + 10, len(ar), len(ma))
    assert np.allclose(fit["ar"], ar, atol=0.08) and np.allclose(fit["ma"], ma, atol=0.08)
    assert abs(fit["sigma2"] - 1) < 0.1


def test_forecast_reverts_to_the_mean_and_widens():
    fit = arma.fit_arma(arma_path((0.7,), ()) + 50, 1, 0)
    values, errors = arma.forecast_arma(fit, 60)
    assert abs(values[-1] - 50) < 1
    assert np.all(np.diff(errors) >= 0)
    assert abs(errors[1] ** 2 / errors[0] ** 2 - (1 + fit["ar"][0] ** 2)) < 1e-9


def test_exogenous_values_are_used():
    rng = np.random.default_rng(1)
    exo = rng.normal(size=(500, 1))
    y = 4 * exo[:, 0] + rng.normal(scale=0.1, size=500)
    fit = arma.fit_arma(y, 1, 0, exo)
    values, _ = arma.forecast_arma(fit, 2, np.array([[1.0], [-1.0]]))
    assert values[0] - values[1] > 6


def test_pacf_of_ar_process():
    x = arma_path((0.6,), ())
    x = x - x.mean()
    acf = np.array([(x[: len(x) - k] * x[k:]).sum() for k in range(6)]) / (x**2).sum()
    pacf = arma.partial_autocorrelation(acf)
    assert abs(pacf[1] - 0.6) < 0.05 and np.all(np.abs(pacf[2:]) < 0.06)


def test_unit_root_test_tells_walk_from_noise():
    rng = np.random.default_rng(2)
    noise = rng.normal(size=400)
    assert arma.unit_root_test(noise)[1] < 0.01
    assert arma.unit_root_test(np.cumsum(noise))[1] > 0.1
    assert np.isnan(arma.unit_root_test(np.ones(50))[0])


def test_walk_forward_equals_a_plain_loop(spark):
    values = arma_path((0.6,), (), n=120) * 3
    df = weekly(spark, values)
    got = arma.walk_forward(df, "series", "week", "y", 3, 3, clamp=True, cutoffs_per_task=5).orderBy("week").collect()
    want = []
    for cut in range(96, 120):
        want.append(max(0.0, arma.forecast_arma(arma.fit_arma(values[:cut], 3, 3), 1)[0][0]))
    assert np.allclose([r.predicted for r in got], want)
    assert np.allclose([r.actual for r in got], values[96:])
    assert got[0].week == day("2020-01-06") + dt.timedelta(days=7 * 96)


def test_classified_rows(spark):
    df = weekly(spark, arma_path((0.5,), (), n=100)).unionByName(weekly(spark, [1.0, 2.0], series="short"))
    result = arma.classified(df, "series", "week", "y")
    counts = {(r.series, r.classification): r["count"] for r in result.groupBy("series", "classification").count().collect()}
    assert counts[("s", "train")] == 80 and counts[("s", "test")] == 20 and counts[("s", "forecast")] == 5
    assert counts[("short", "train")] == 1 and ("short", "forecast") not in counts
    ahead = result.where("series = 's' AND classification = 'forecast'").orderBy("week").collect()
    assert ahead[0].week == day("2020-01-06") + dt.timedelta(days=700)
    assert all(r.conf_lower < r.predicted < r.conf_upper for r in ahead)


def test_stored_models_forecast_like_fresh_ones(spark, tmp_path):
    df = weekly(spark, arma_path((0.5,), (0.3,), n=150))
    path = str(tmp_path / "models")
    arma.fit_models(df, "series", "week", "y", 2, 1).write.parquet(path)
    stored = arma.forecast_models(spark.read.parquet(path), "series", "week", 4)
    assert np.allclose(column(stored, "predicted"), arma.forecast_arma(arma.fit_arma(arma_path((0.5,), (0.3,), n=150), 2, 1), 4)[0])
    assert rows(stored) == rows(arma.forecast(df, "series", "week", "y", 4, 2, 1))


def test_stored_models_are_carried_over_new_values(spark):
    values = arma_path((0.5,), (0.3,), n=160)
    df = weekly(spark, values)
    old = df.where(df.week < day("2020-01-06") + dt.timedelta(days=7 * 120))
    models = arma.fit_models(old, "series", "week", "y", 2, 1)
    fit = arma.fit_arma(values[:120], 2, 1)
    x, e, want = list(fit["x"]), list(fit["shocks"]), []
    for value in values[120:]:
        step = fit["const"] + fit["ar"][0] * x[-1] + fit["ar"][1] * x[-2] + fit["ma"][0] * e[-1]
        want.append(step + fit["mean"])
        x.append(value - fit["mean"])
        e.append(x[-1] - step)
    result = arma.classified(df, "series", "week", "y", 0.25, 3, models=models)
    told = result.where("classification = 'test'").orderBy("week").collect()
    assert np.allclose([r.predicted for r in told], want) and np.allclose([r.actual for r in told], values[120:])
    ahead = result.where("classification = 'forecast'").orderBy("week").collect()
    assert np.allclose([r.predicted for r in ahead], arma.forecast_arma(fit | {"x": np.array(x), "shocks": np.array(e)}, 3)[0])
    assert ahead[0].week == day("2020-01-06") + dt.timedelta(days=7 * 160)
    # Carried in two steps, through stored states, the model is the same; without new values it forecasts like a fresh one.
    half = df.where(df.week < day("2020-01-06") + dt.timedelta(days=7 * 140))
    first = arma.carry_models(models, half, "series", "week", "y").select("series", "last_date", "model")
    late = df.where(df.week >= day("2020-01-06") + dt.timedelta(days=7 * 140))
    second = arma.carry_models(first, late, "series", "week", "y")
    assert np.allclose(column(arma.forecast_models(second, "series", "week", 3), "predicted"), [r.predicted for r in ahead])
    same = arma.carry_models(models, old, "series", "week", "y")
    assert rows(arma.forecast_models(same, "series", "week", 3)) == rows(arma.forecast_models(models, "series", "week", 3))


def test_classified_with_regressors_and_unknown_series(spark):
    rng = np.random.default_rng(9)
    exo = rng.normal(size=204)
    y = 5 * exo[:200] + rng.normal(scale=0.1, size=200)
    frame = weekly(spark, exo).withColumnRenamed("y", "x")
    known = weekly(spark, y).join(frame, ["series", "week"])
    later = frame.join(known, ["series", "week"], "left_anti")
    models = arma.fit_models(known.orderBy("week").limit(150), "series", "week", "y", 1, 0, ["x"])
    other = known.limit(30).withColumn("series", known.series.substr(1, 0))
    for stored, data in ((None, known), (models, known.unionByName(other))):
        got = arma.classified(data, "series", "week", "y", 0.2, 4, 1, 0, exo=["x"], future_exo=later, models=stored)
        told = got.where("classification = 'test' AND series = 's'").orderBy("week").collect()
        assert np.allclose([r.predicted for r in told], y[160:], atol=0.6)
        ahead = got.where("classification = 'forecast'").orderBy("week").collect()
        assert np.allclose([r.predicted for r in ahead], 5 * exo[200:], atol=0.6)
    assert got.where("series = '' AND predicted IS NOT NULL").count() == 0
    assert got.where("series = ''").groupBy("classification").count().count() == 2


def test_forecast_with_future_regressor(spark):
    rng = np.random.default_rng(9)
    exo = rng.normal(size=204)
    y = 5 * exo[:200] + rng.normal(scale=0.1, size=200)
    df = weekly(spark, y)
    frame = weekly(spark, exo).withColumnRenamed("y", "x")
    known = df.join(frame, ["series", "week"])
    later = frame.join(df, ["series", "week"], "left_anti")
    got = column(arma.forecast(known, "series", "week", "y", 4, 1, 0, exo=["x"], future_exo=later), "predicted")
    assert np.allclose(got, 5 * exo[200:], atol=0.5)


# Additive model


def test_additive_fit_finds_trend_and_week(spark):
    start = day("2021-01-01")
    season = [0, 3, 6, 3, 0, -6, -6]
    data = [("s", start + dt.timedelta(days=i), 100 + 0.5 * i + season[i % 7]) for i in range(200)]
    df = spark.createDataFrame(data, "series string, ds timestamp_ntz, y double")
    frame = additive.future_dates(df, "series", "ds", 28)
    parts = additive.components(frame, additive.fit(df, "series", "ds", "y"), "series", "ds")
    got = [r.yhat for r in additive.predict(parts, "series", "ds").orderBy("ds").collect()]
    want = [100 + 0.5 * i + season[i % 7] for i in range(228)]
    assert len(got) == 228
    assert np.max(np.abs(np.array(got[:200]) - want[:200])) < 1.0
    assert np.max(np.abs(np.array(got) - want)) < 4.0


def test_components_in_spark_equal_numpy(spark):
    rng = np.random.default_rng(4)
    days = np.arange(18000.0, 18900.0)
    y = rng.normal(size=900).cumsum() + 50
    model = additive.fit_additive(days, y)
    data = [("s", dt.datetime(1970, 1, 1) + dt.timedelta(days=int(d)), float(v)) for d, v in zip(days, y)]
    df = spark.createDataFrame(data, "series string, ds timestamp_ntz, y double")
    parts = additive.components(df.select("series", "ds"), additive.fit(df, "series", "ds", "y"), "series", "ds").orderBy("ds").collect()
    k = np.arange(1, 11)
    angle = 2 * np.pi * np.outer(days, k) / additive.YEAR_DAYS
    yearly = np.hstack([np.sin(angle), np.cos(angle)]) @ np.array(model["yearly"])
    t = (days - model["start"]) / model["span"]
    trend = model["level"] + model["slope"] * t + np.maximum(t[:, None] - np.array(model["points"]), 0) @ np.array(model["bends"])
    assert np.allclose([r.yearly for r in parts], yearly, atol=1e-6)
    assert np.allclose([r.trend for r in parts], trend, atol=1e-6)


def test_single_day_series(spark):
    df = spark.createDataFrame([("s", day("2021-01-01"), 5.0)], "series string, ds timestamp_ntz, y double")
    parts = additive.components(additive.future_dates(df, "series", "ds", 2), additive.fit(df, "series", "ds", "y"), "series", "ds")
    assert additive.predict(parts, "series", "ds").count() == 3
