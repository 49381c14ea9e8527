"""ARMA fits per series, run by Spark over many series and cut-offs.

A series travels as one array ordered by date. It holds one value per grid date, so its length is bounded by the
calendar. Refits are split into chunks of cut-offs, which spreads even a handful of series over many tasks. The
numeric helpers work on one series in numpy.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.clean import clamp_negative
from caseloom.session import materialize

# Polynomial coefficients of the published response surface for the unit-root test with a constant,
# small-p and large-p branch, and the statistic limits between and around them.
ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_STAR, ADF_MIN, ADF_MAX = -1.61, -18.83, 2.74

CUTOFFS_PER_TASK = 16


def _lagged(x: np.ndarray, lags: int, start: int) -> np.ndarray:
    return np.column_stack([x[start - k : len(x) - k] for k in range(1, lags + 1)]) if lags else np.empty((len(x) - start, 0))


def fit_arma(y: np.ndarray, p: int, q: int, exo: np.ndarray | None = None) -> dict | None:
    """Two-stage least squares: a long autoregression gives the shocks, then one regression on lags of both."""
    n = len(y)
    k_exo = 0 if exo is None else exo.shape[1]
    long_order = min(max(p, q) + int(math.ceil(math.log(max(n, 2)) ** 1.5)), max(n // 4, 1))
    start = long_order + q
    if n - start <= p + q + k_exo + 1 or start < p:
        return None
    mean = y.mean()
    x = y - mean
    lags = _lagged(x, long_order, long_order)
    shocks = np.zeros(n)
    shocks[long_order:] = x[long_order:] - lags @ np.linalg.lstsq(lags, x[long_order:], rcond=None)[0]
    columns = [np.ones((n - start, 1)), _lagged(x, p, start), _lagged(shocks, q, start)]
    if exo is not None:
        columns.append(exo[start:n])
    design = np.hstack(columns)
    beta = np.linalg.lstsq(design, x[start:], rcond=None)[0]
    shocks[start:] = x[start:] - design @ beta
    sigma2 = float(np.mean(shocks[start:] ** 2))
    return {
        "mean": mean, "const": beta[0], "ar": beta[1 : 1 + p], "ma": beta[1 + p : 1 + p + q],
        "exo": beta[1 + p + q :], "sigma2": sigma2, "x": x, "shocks": shocks,
    }


def forecast_arma(fit: dict, steps: int, future_exo: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Point forecasts and their standard errors (psi weights) for 1..steps ahead."""
    ar, ma = fit["ar"], fit["ma"]
    x, e = list(fit["x"]), list(fit["shocks"])
    for h in range(steps):
        value = fit["const"] + sum(a * x[-i - 1] for i, a in enumerate(ar)) + sum(b * e[-i - 1] for i, b in enumerate(ma))
        if future_exo is not None:
            value += float(future_exo[h] @ fit["exo"])
        x.append(value)
        e.append(0.0)
    psi = [1.0]
    for j in range(1, steps):
        psi.append((ma[j - 1] if j <= len(ma) else 0.0) + sum(a * psi[j - i - 1] for i, a in enumerate(ar) if j - i - 1 >= 0))
    return np.array(x[-steps:]) + fit["mean"], np.sqrt(fit["sigma2"] * np.cumsum(np.square(psi)))


def step_arma(fit: dict, y: np.ndarray, seen: int, exo: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One-step predictions of every value under fixed parameters, and the last values and shocks after them.

    The first ``seen`` values are those the model was fitted to; they run from a start at the mean. The values after them
    run from the state that the model holds.
    """
    ar, ma = np.asarray(fit["ar"], dtype=float), np.asarray(fit["ma"], dtype=float)
    x, e = np.zeros(len(ar)), np.zeros(len(ma))
    fixed = fit["const"] + (exo @ np.asarray(fit["exo"], dtype=float) if exo is not None else np.zeros(len(y)))
    told = np.empty(len(y))
    for t in range(len(y) + 1):
        if t == seen:
            x, e = np.asarray(fit["x"], dtype=float)[::-1], np.asarray(fit["shocks"], dtype=float)[::-1]
        if t < len(y):
            told[t] = fixed[t] + ar @ x + ma @ e
            value = y[t] - fit["mean"]
            x, e = np.append(value, x)[: len(ar)], np.append(value - told[t], e)[: len(ma)]
    return told + fit["mean"], x[::-1], e[::-1]


def partial_autocorrelation(acf: np.ndarray) -> np.ndarray:
    """Durbin-Levinson recursion on autocorrelations 0..n."""
    out, phi = [1.0], np.empty(0)
    for k in range(1, len(acf)):
        below = 1.0 - phi @ acf[1:k]
        top = (acf[k] - phi @ acf[1:k][::-1]) / below if below > 0 else np.nan
        phi = np.append(phi - top * phi[::-1], top)
        out.append(top)
    return np.array(out)


def unit_root_test(y: np.ndarray) -> tuple[float, float, int]:
    """Augmented unit-root test with a constant: statistic, p-value, lags chosen by AIC on a common sample."""
    n = len(y)
    top = min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 2)
    if top < 0 or np.ptp(y) == 0:
        return math.nan, math.nan, 0
    diff = np.diff(y)

    def regress(lags: int, start: int):
        target = diff[start:]
        design = np.hstack([y[start:-1, None], _lagged(diff, lags, start), np.ones((len(target), 1))])
        beta = np.linalg.lstsq(design, target, rcond=None)[0]
        rest = target - design @ beta
        return design, beta, float(rest @ rest), len(target)

    def aic(lags: int) -> float:
        design, _, rss, rows = regress(lags, top)
        return rows * math.log(max(rss, 1e-300) / rows) + 2 * design.shape[1]

    best = min(range(top + 1), key=aic)
    design, beta, rss, rows = regress(best, best)
    error = math.sqrt(rss / (rows - design.shape[1]) * np.linalg.pinv(design.T @ design)[0, 0])
    stat = float(beta[0] / error) if error > 0 else math.nan
    if math.isnan(stat) or stat > ADF_MAX:
        return stat, (math.nan if math.isnan(stat) else 1.0), best
    if stat < ADF_MIN:
        return stat, 0.0, best
    powers = ADF_SMALL_P if stat <= ADF_STAR else ADF_LARGE_P
    z = sum(c * stat**i for i, c in enumerate(powers))
    return stat, 0.5 * math.erfc(-z / math.sqrt(2.0)), best


def as_arrays(df: DataFrame, series: str, date: str, value: str, exo: list[str] | None = None) -> DataFrame:
    """One row per series: dates ``ds``, values ``ys`` and optional regressor rows ``xs``, in date order, nulls removed."""
    used = [value, *(exo or [])]
    known = df.dropna("any", subset=used)
    cells = F.struct(F.col(date).alias("d"), F.col(value).cast("double").alias("y"),
                     F.array(*[F.col(c).cast("double") for c in exo or []]).cast("array<double>").alias("x"))
    rows = known.groupBy(series).agg(F.sort_array(F.collect_list(cells)).alias("rows"))
    return rows.select(series, F.col("rows.d").alias("ds"), F.col("rows.y").alias("ys"), F.col("rows.x").alias("xs"))


def _matrix(xs, rows: int) -> np.ndarray | None:
    return np.array([np.asarray(x, dtype=float) for x in xs[:rows]]) if rows and len(xs[0]) else None


def walk_forward(
    df: DataFrame, series: str, date: str, value: str, p: int = 3, q: int = 3, val_share: float = 0.2,
    clamp: bool = False, cutoffs_per_task: int = CUTOFFS_PER_TASK, exo: list[str] | None = None,
) -> DataFrame:
    """One-step predictions for the last ``val_share`` of each series, refitted on the actual values before each step.

    The history holds actual values only, so cut-offs do not depend on each other and run in parallel. ``clamp``
    turns negative predictions into 0. ``exo`` names regressors, also known on the predicted date.
    """
    names = exo or []

    @F.pandas_udf("array<double>")
    def predict(ys: pd.Series, xs: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
        def steps(y, x, lo, hi):
            out = []
            known = _matrix(x, hi) if names else None
            for cut in range(lo, hi):
                fit = fit_arma(np.asarray(y[:cut], dtype=float), p, q, known[:cut] if names else None)
                out.append(float(forecast_arma(fit, 1, known[cut : cut + 1] if names else None)[0][0]) if fit else None)
            return out

        return pd.Series([steps(*row) for row in zip(ys, xs, low, high)])

    arrays = as_arrays(df, series, date, value, names)
    size = F.size("ys")
    sized = arrays.withColumn("__first", F.floor(size * (1 - val_share)).cast("int")).where(size > F.col("__first"))
    chunks = sized.withColumn("__low", F.explode(F.sequence(F.col("__first"), size - 1, F.lit(cutoffs_per_task))))
    chunks = chunks.withColumn("__high", F.least(F.col("__low") + cutoffs_per_task, size))
    spread = chunks.repartition(series, "__low")
    span = F.col("__high") - F.col("__low")
    told = spread.select(
        series,
        F.inline(F.arrays_zip(
            F.slice("ds", F.col("__low") + 1, span).alias(date),
            predict("ys", "xs", "__low", "__high").alias("predicted"),
            F.slice("ys", F.col("__low") + 1, span).alias("actual"),
        )).alias(date, "predicted", "actual"),
    )
    if clamp:
        told = told.withColumn("predicted", clamp_negative(F.col("predicted")))
    return told


MODEL_SCHEMA = (
    "struct<mean:double,const:double,ar:array<double>,ma:array<double>,exo:array<double>,sigma2:double,"
    "x:array<double>,shocks:array<double>>"
)


def fit_models(
    df: DataFrame, series: str, date: str, value: str, p: int = 3, q: int = 3, exo: list[str] | None = None
) -> DataFrame:
    """One fitted model per series: coefficients, the values and shocks a forecast starts from, the last date.

    The table can be stored and used later. A series too short for the order has a null model.
    """
    names = exo or []

    @F.pandas_udf(MODEL_SCHEMA)
    def fit(ys: pd.Series, xs: pd.Series) -> pd.DataFrame:
        def one(y, x):
            found = fit_arma(np.asarray(y, dtype=float), p, q, _matrix(x, len(y)) if names else None)
            if found is None:
                return dict.fromkeys(("mean", "const", "ar", "ma", "exo", "sigma2", "x", "shocks"))
            tails = {k: found[k][-n:].tolist() if n else [] for k, n in (("x", p), ("shocks", q))}
            return {k: v.tolist() if isinstance(v, np.ndarray) else float(v) for k, v in found.items()} | tails

        return pd.DataFrame([one(*row) for row in zip(ys, xs)])

    arrays = as_arrays(df, series, date, value, names).repartition(series)
    fitted = arrays.select(series, F.element_at("ds", -1).alias("last_date"), fit("ys", "xs").alias("model"))
    return fitted.withColumn("model", F.when(F.col("model.sigma2").isNotNull(), F.col("model")))


def forecast_models(
    models: DataFrame, series: str, date: str, steps: int = 5, step_days: int = 7, confidence_z: float = 1.959963984540054,
    exo: list[str] | None = None, future_exo: DataFrame | None = None,
) -> DataFrame:
    """``steps`` forecasts per fitted series with confidence bounds, dated +1..+steps grid steps after its last value.

    ``future_exo`` holds the regressor columns for the forecast dates of each series.
    """
    names = exo or []
    known = models.where(F.col("model").isNotNull())
    if names:
        ahead = as_arrays(future_exo.withColumn("__y", F.lit(0.0)), series, date, "__y", names)
        known = known.join(ahead.where(F.size("xs") >= steps).select(series, F.col("xs").alias("__fx")), series)
    else:
        known = known.withColumn("__fx", F.lit(None).cast("array<array<double>>"))

    @F.pandas_udf("array<struct<predicted:double,error:double>>")
    def predict(model: pd.DataFrame, fx: pd.Series) -> pd.Series:
        def one(fit, f):
            values, errors = forecast_arma(fit, steps, _matrix(f, steps) if names else None)
            return [{"predicted": float(v), "error": float(e)} for v, e in zip(values, errors)]

        return pd.Series([one(*row) for row in zip(model.to_dict("records"), fx)])

    told = known.select(series, "last_date", F.posexplode(predict("model", "__fx")).alias("__i", "__f"))
    margin = F.col("__f.error") * confidence_z
    return told.select(
        series,
        (F.col("last_date") + F.make_dt_interval(days=(F.col("__i") + 1) * step_days)).alias(date),
        F.col("__f.predicted").alias("predicted"),
        (F.col("__f.predicted") - margin).alias("conf_lower"),
        (F.col("__f.predicted") + margin).alias("conf_upper"),
    )


def forecast(df: DataFrame, series: str, date: str, value: str, steps: int = 5, p: int = 3, q: int = 3, **options) -> DataFrame:
    """Fit and forecast in one go; ``options`` as for ``forecast_models``."""
    models = fit_models(df, series, date, value, p, q, options.get("exo"))
    return forecast_models(models, series, date, steps, **options)


def carry_models(
    models: DataFrame, df: DataFrame, series: str, date: str, value: str, exo: list[str] | None = None
) -> DataFrame:
    """Every series run through its stored model without refitting: ``ds``, ``ys``, one-step predictions ``told`` and the
    model carried on to the last date, ready to be stored or to forecast from.

    Values after the model's last date run from its state, which expects the next date of the grid; earlier ones from a
    start at the mean. A series without a model, or with a null one, has null predictions and no model.
    """
    names = exo or []

    @F.pandas_udf("struct<told:array<double>,x:array<double>,shocks:array<double>>")
    def run(model: pd.DataFrame, ys: pd.Series, xs: pd.Series, seen: pd.Series) -> pd.DataFrame:
        def one(fit, y, x, n):
            known = _matrix(x, len(y)) if names else None
            told, last, shocks = step_arma(fit, np.asarray(y, dtype=float), n, known)
            return {"told": told.tolist(), "x": last.tolist(), "shocks": shocks.tolist()}

        return pd.DataFrame([one(*row) for row in zip(model.to_dict("records"), ys, xs, seen)], columns=["told", "x", "shocks"])

    arrays = as_arrays(df, series, date, value, names)
    usable = models.where(F.col("model").isNotNull()).select(F.col(series).alias("__s"), F.col("last_date").alias("__at"), "model")
    both = arrays.join(usable, F.col(series).eqNullSafe(F.col("__s")), "left")
    seen = F.size(F.filter("ds", lambda d: d <= F.col("__at")))
    known = both.where(F.col("model").isNotNull()).withColumn("__run", run("model", "ys", "xs", seen))
    carried = F.col("model").withField("x", F.col("__run.x")).withField("shocks", F.col("__run.shocks"))
    last = F.greatest("__at", F.element_at("ds", -1)).alias("last_date")
    done = known.select(series, "ds", "ys", F.col("__run.told").alias("told"), last, carried.alias("model"))
    rest = both.where(F.col("model").isNull()).select(series, "ds", "ys", F.element_at("ds", -1).alias("last_date"))
    return done.unionByName(rest, allowMissingColumns=True)


def carried_steps(carried: DataFrame, series: str, date: str, val_share: float = 1.0) -> DataFrame:
    """The last ``val_share`` of every carried series as rows: date, one-step prediction, actual value."""
    told = F.coalesce("told", F.array().cast("array<double>")).alias("told")
    rows = F.posexplode(F.arrays_zip("ds", "ys", told)).alias("__i", "r")
    placed = carried.select(series, F.floor(F.size("ys") * (1 - val_share)).alias("__first"), rows)
    return placed.where(F.col("__i") >= F.col("__first")).select(
        series, F.col("r.ds").alias(date), F.col("r.told").alias("predicted"), F.col("r.ys").alias("actual")
    )


def classified(
    df: DataFrame, series: str, date: str, value: str, val_share: float = 0.2, steps: int = 5, p: int = 3, q: int = 3,
    clamp: bool = False, exo: list[str] | None = None, future_exo: DataFrame | None = None, models: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Train, test and forecast rows of each series in one table.

    ``exo`` names regressors of all steps, ``future_exo`` holds them for the forecast dates. With stored ``models`` (from
    ``fit_models``) nothing is fitted: test rows are one-step predictions under the models' parameters, and the forecast
    starts from the models carried on to the last date. ``options`` go to ``forecast_models``.
    """
    if models is None:
        arrays = as_arrays(df, series, date, value, exo)
        test = walk_forward(df, series, date, value, p, q, val_share, exo=exo)
        ahead = forecast(df, series, date, value, steps, p, q, exo=exo, future_exo=future_exo, **options)
    else:
        arrays = materialize(carry_models(models, df, series, date, value, exo), "carried")
        test = carried_steps(arrays, series, date, val_share)
        ahead = forecast_models(arrays.select(series, "last_date", "model"), series, date, steps, exo=exo, future_exo=future_exo, **options)
    if clamp:
        test = test.withColumn("predicted", clamp_negative(F.col("predicted")))
    first = F.floor(F.size("ys") * (1 - val_share)).cast("int")
    train = arrays.select(series, F.explode(F.slice(F.arrays_zip("ds", "ys"), F.lit(1), first)).alias("r")).select(
        series, F.col("r.ds").alias(date), F.lit(None).cast("double").alias("predicted"), F.col("r.ys").alias("actual"),
        F.lit("train").alias("classification"),
    )
    both = train.unionByName(test.withColumn("classification", F.lit("test")))
    return both.unionByName(ahead.withColumn("classification", F.lit("forecast")), allowMissingColumns=True)


def partial_autocorrelations(acf: DataFrame, series: str) -> DataFrame:
    """Partial autocorrelations from an autocorrelation table ``(series, lag, acf)``; a series has one row per lag."""

    @F.pandas_udf("array<double>")
    def recurse(values: pd.Series) -> pd.Series:
        return pd.Series([partial_autocorrelation(np.asarray(v, dtype=float)).tolist() for v in values])

    rows = acf.groupBy(series).agg(F.sort_array(F.collect_list(F.struct("lag", "acf"))).alias("r"))
    return rows.select(series, F.posexplode(recurse(F.col("r.acf"))).alias("lag", "pacf"))


def stationarity(df: DataFrame, series: str, date: str, value: str) -> DataFrame:
    """Unit-root statistic, p-value and chosen lag count per series."""

    @F.pandas_udf("struct<statistic:double,p_value:double,lags:long>")
    def test(ys: pd.Series) -> pd.DataFrame:
        rows = [unit_root_test(np.asarray(y, dtype=float)) for y in ys]
        return pd.DataFrame(rows, columns=["statistic", "p_value", "lags"])

    arrays = as_arrays(df, series, date, value).repartition(series)
    return arrays.withColumn("t", test("ys")).select(series, F.col("t.statistic"), F.col("t.p_value"), F.col("t.lags"))

