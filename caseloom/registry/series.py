"""Queries over time series, decomposition and forecasts.

Series are order priorities. Values are whole thousands, so that sums over windows are exact in any order; half a cent
is added before the cut because the sum itself is not.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caseloom.functions.dates import quarter_start, week_start
from caseloom.operators import additive, arma
from caseloom.operators import timeseries as ts
from caseloom.operators.asof import asof_join
from caseloom.plans.forecasting import decompose, export_frame, forecast_all
from caseloom.registry.core import Tables, query
from caseloom.session import materialize

WEEKLY_SQL = """w AS (SELECT o_orderpriority AS series, date_trunc('week', o_orderdate) AS week, floor((sum(o_totalprice) + 0.005) / 1000) AS y
    FROM orders GROUP BY 1, 2)"""


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _grid(t: Tables, grid, name: str):
    return t("orders").groupBy(F.col("o_orderpriority").alias("series"), grid("o_orderdate").alias(name)).agg(
        F.floor((F.sum("o_totalprice") + 0.005) / 1000).cast("double").alias("y")
    )


def _weekly(t: Tables):
    return _grid(t, week_start, "week")


@query(
    "ts_fill_weeks",
    """WITH d AS (SELECT o_orderpriority AS series, o_orderdate AS day, nullif(count(*), 2) AS n, round(sum(o_totalprice), 2) AS y
      FROM orders WHERE o_totalprice > 100000 GROUP BY 1, 2),
    g AS (SELECT series, unnest(generate_series(min(day), TIMESTAMP '2001-10-01', INTERVAL 7 DAY)) AS day FROM d GROUP BY series)
    SELECT g.series, g.day, CASE WHEN d.day IS NULL THEN 0 ELSE d.n END AS n, CASE WHEN d.day IS NULL THEN 0 ELSE d.y END AS y
    FROM g LEFT JOIN d USING (series, day)""",
)
def ts_fill_weeks(t: Tables):
    daily = t("orders").where("o_totalprice > 100000").groupBy(
        F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("day")
    ).agg(F.nullif(F.count(F.lit(1)), F.lit(2)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("y"))
    return ts.fill_weeks(daily, "series", "day", ["n", "y"], _moment("2001-10-01"))


@query(
    "reindex_weekly",
    """WITH d AS (SELECT o_orderstatus AS series, date_trunc('week', o_orderdate) AS week, count(*) AS n FROM orders WHERE o_totalprice > 480000 GROUP BY 1, 2),
    g AS (SELECT series, unnest(generate_series(min(week), TIMESTAMP '2001-09-03', INTERVAL 7 DAY)) AS week FROM d GROUP BY series)
    SELECT g.series, g.week, coalesce(n, 0) AS n FROM g LEFT JOIN d USING (series, week)""",
)
def reindex_weekly(t: Tables):
    rare = t("orders").where("o_totalprice > 480000").groupBy(
        F.col("o_orderstatus").alias("series"), week_start("o_orderdate").alias("week")
    ).agg(F.count(F.lit(1)).alias("n"))
    return ts.fill_weeks(rare, "series", "week", ["n"], _moment("2001-09-03"))


QUARTERLY_SQL = """q AS (SELECT o_orderpriority AS series, date_trunc('quarter', o_orderdate) AS quarter, floor((sum(o_totalprice) + 0.005) / 1000) AS y
    FROM orders GROUP BY 1, 2)"""


@query(
    "ts_resample_weekly",
    f"""WITH {QUARTERLY_SQL}, s AS (SELECT series, min(quarter) AS a, max(quarter) AS b FROM q GROUP BY 1),
    g AS (SELECT series, unnest(generate_series(a + INTERVAL 1 DAY * ((7 - isodow(a)) % 7), b + INTERVAL 1 DAY * ((7 - isodow(b)) % 7), INTERVAL 7 DAY)) AS week FROM s)
    SELECT g.series, g.week AS quarter, q.y FROM g ASOF JOIN q ON g.series = q.series AND g.week >= q.quarter""",
)
def ts_resample_weekly(t: Tables):
    return ts.resample_weekly(_grid(t, quarter_start, "quarter"), ["series"], "quarter", ["y"])


@query(
    "resample_ffill",
    """WITH q AS (SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY 1), s AS (SELECT min(month) AS a, max(month) AS b FROM q),
    g AS (SELECT unnest(generate_series(a + INTERVAL 1 DAY * ((7 - isodow(a)) % 7), b + INTERVAL 1 DAY * ((7 - isodow(b)) % 7), INTERVAL 7 DAY)) AS week FROM s)
    SELECT g.week AS month, q.n FROM g ASOF JOIN q ON g.week >= q.month""",
)
def resample_ffill(t: Tables):
    monthly = t("orders").groupBy(F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month"))
    return ts.resample_weekly(monthly.agg(F.count(F.lit(1)).alias("n")), [], "month", ["n"])


REGRESSOR_SQL = """lv AS (SELECT date_trunc('quarter', o_orderdate) AS day, CAST(count(*) AS DOUBLE) AS level FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01' GROUP BY 1
      UNION ALL SELECT TIMESTAMP '2001-07-01', 2500 UNION ALL SELECT TIMESTAMP '2001-10-01', 2600),
    sh AS (SELECT date_trunc('quarter', l_shipdate) AS day, CAST(sum(l_linenumber) % 17 AS DOUBLE) AS share FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-04-01' GROUP BY 1
      UNION ALL SELECT TIMESTAMP '2001-04-01', 11 UNION ALL SELECT TIMESTAMP '2001-07-01', 11 UNION ALL SELECT TIMESTAMP '2001-10-01', 11),
    p AS (SELECT lv.day, level * (share / 100) AS v FROM lv LEFT JOIN sh ON lv.day = sh.day),
    b AS (SELECT min(day) AS a, max(day) AS z FROM p),
    g AS (SELECT unnest(generate_series(a + INTERVAL 1 DAY * ((7 - isodow(a)) % 7), z + INTERVAL 1 DAY * ((7 - isodow(z)) % 7), INTERVAL 7 DAY)) AS day FROM b),
    k AS (SELECT g.day, v * 4 / 52 AS v FROM g ASOF JOIN p ON g.day >= p.day),
    x AS (SELECT day, avg(v) OVER (ORDER BY day ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS exo FROM k)"""


def _regressor(t: Tables):
    level = t("orders").where("o_orderdate < timestamp_ntz'2001-07-01'").groupBy(quarter_start("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).cast("double").alias("level")
    )
    share = t("lineitem").where("l_shipdate < timestamp_ntz'2001-04-01'").groupBy(quarter_start("l_shipdate").alias("day")).agg(
        (F.sum("l_linenumber") % 17).cast("double").alias("share")
    )
    quarters = [dt.datetime(2001, m, 1) for m in (4, 7, 10)]
    return ts.regressor(
        level, share, "day", "level", "share", "exo",
        [{"day": d, "level": v} for d, v in zip(quarters[1:], (2500.0, 2600.0))], [{"day": d, "share": 11.0} for d in quarters],
    )


@query("ts_regressor", f"WITH {REGRESSOR_SQL} SELECT day, round(exo, 6) AS exo FROM x")
def ts_regressor(t: Tables):
    return _regressor(t).withColumn("exo", F.round("exo", 6))


@query(
    "ts_adjust_baseline",
    f"""WITH {WEEKLY_SQL}, m AS (SELECT series, avg(y) FILTER (week <= TIMESTAMP '1997-01-01') AS lo,
      avg(y) FILTER (week > TIMESTAMP '1997-01-01' AND week <= TIMESTAMP '1999-06-30') AS hi FROM w GROUP BY 1)
    SELECT series, week, round(CASE WHEN week <= TIMESTAMP '1997-01-01' THEN y + hi - lo ELSE y END, 4) AS y FROM w JOIN m USING (series)""",
)
def ts_adjust_baseline(t: Tables):
    lifted = ts.adjust_baseline(_weekly(t), "series", "week", "y", _moment("1997-01-01"), _moment("1999-06-30"))
    return lifted.withColumn("y", F.round("y", 4))


TREND_SQL = f"""{WEEKLY_SQL}, tr AS (SELECT *, CASE WHEN count(y) OVER o = 52 THEN avg(y) OVER o END AS trend FROM w
    WINDOW o AS (PARTITION BY series ORDER BY week ROWS BETWEEN 51 PRECEDING AND CURRENT ROW))"""


@query("ts_trend", f"WITH {TREND_SQL} SELECT series, week, y, round(trend, 6) AS trend FROM tr")
def ts_trend(t: Tables):
    return ts.trend(_weekly(t), "series", "week", "y").withColumn("trend", F.round("trend", 6))


# The external weeks end on Sunday; one day later is the Monday the series are dated by.
COMBINED_SQL = f"""{TREND_SQL}, {REGRESSOR_SQL},
    e AS (SELECT series, CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS week, exo FROM x, (SELECT DISTINCT series FROM w)),
    c AS (SELECT coalesce(tr.series, e.series) AS series, coalesce(tr.week, e.week) AS week, y, trend, exo
      FROM tr FULL JOIN e ON tr.series = e.series AND tr.week = e.week)"""


def _combined(t: Tables):
    with_trend = ts.trend(_weekly(t), "series", "week", "y")
    return ts.add_regressor(with_trend, "series", "week", _regressor(t).withColumnRenamed("day", "week"), 1)


@query(
    "ts_trend_regression",
    f"""WITH {COMBINED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY week) AS i, count(*) OVER (PARTITION BY series) AS n
      FROM c WHERE y IS NOT NULL AND trend IS NOT NULL AND exo IS NOT NULL),
    f AS (SELECT series, regr_slope(trend, exo) AS a, regr_intercept(trend, exo) AS b FROM r WHERE i <= floor(n * CAST(0.8 AS DOUBLE)) GROUP BY 1)
    SELECT series, week, round(b + a * exo, 3) AS predicted_trend FROM c JOIN f USING (series)""",
)
def ts_trend_regression(t: Tables):
    fitted = ts.trend_regression(_combined(t), "series", "week", "trend", "exo")
    return fitted.select("series", "week", F.round("predicted_trend", 3).alias("predicted_trend"))


SEASON_SQL = f"""{TREND_SQL}, sm AS (SELECT *, CASE WHEN count(y - trend) OVER o = 10 THEN avg(y - trend) OVER o END AS smooth FROM tr
      WINDOW o AS (PARTITION BY series ORDER BY week ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING)),
    se AS (SELECT *, avg(smooth) OVER (PARTITION BY series, week(week)) AS seasonality FROM sm)"""


def _seasonal(t: Tables):
    return ts.seasonality(ts.trend(_weekly(t), "series", "week", "y"), "series", "week", "y", "trend")


@query("ts_seasonality", f"WITH {SEASON_SQL} SELECT series, week, round(seasonality, 6) AS seasonality FROM se")
def ts_seasonality(t: Tables):
    return _seasonal(t).select("series", "week", F.round("seasonality", 6).alias("seasonality"))


@query("ts_residual", f"WITH {SEASON_SQL} SELECT series, week, round(y - trend - seasonality, 6) AS residual FROM se")
def ts_residual(t: Tables):
    left = ts.residual(_seasonal(t), "y", "trend", "seasonality")
    return left.select("series", "week", F.round("residual", 6).alias("residual"))


@query(
    "ts_acf",
    f"""WITH {WEEKLY_SQL}, x AS (SELECT series, y - avg(y) OVER (PARTITION BY series) AS x, row_number() OVER (PARTITION BY series ORDER BY week) AS i FROM w),
    v AS (SELECT series, sum(x * x) AS s FROM x GROUP BY 1)
    SELECT a.series, CAST(k AS INTEGER) AS lag, round(sum(a.x * b.x) / any_value(s), 6) AS acf FROM x a, range(0, 26) r(k), x b, v
    WHERE a.series = b.series AND b.i = a.i + k AND v.series = a.series GROUP BY 1, 2""",
)
def ts_acf(t: Tables):
    return ts.autocorrelation(_weekly(t), "series", "week", "y").withColumn("acf", F.round("acf", 6))


@query(
    "ts_y_pred",
    f"""WITH {SEASON_SQL} SELECT series, week, classification, round(CASE WHEN classification <> 'train' THEN trend + seasonality + residual END, 4) AS y_prediction
    FROM (SELECT *, nullif(y, 0) / 10 AS residual, CASE WHEN week < TIMESTAMP '2000-01-01' THEN 'train' WHEN week < TIMESTAMP '2001-01-01' THEN 'test' ELSE 'forecast' END AS classification FROM se)""",
)
def ts_y_pred(t: Tables):
    classes = F.when(F.col("week") < _moment("2000-01-01"), "train").when(F.col("week") < _moment("2001-01-01"), "test").otherwise("forecast")
    marked = _seasonal(t).withColumn("residual", F.col("y") / 10).withColumn("classification", classes)
    total = ts.total_prediction(marked, "trend", "seasonality", "residual", "classification")
    return total.select("series", "week", "classification", F.round("y_prediction", 4).alias("y_prediction"))


@query("ts_pacf")
def ts_pacf(t: Tables):
    return arma.partial_autocorrelations(ts.autocorrelation(_weekly(t), "series", "week", "y"), "series")


@query("ts_adf")
def ts_adf(t: Tables):
    return arma.stationarity(_weekly(t), "series", "week", "y")


@query("ts_walk_forward")
def ts_walk_forward(t: Tables):
    return arma.walk_forward(_weekly(t), "series", "week", "y", clamp=True)


@query("ts_forecast")
def ts_forecast(t: Tables):
    return arma.forecast(_weekly(t), "series", "week", "y", steps=5)


@query("ts_classified")
def ts_classified(t: Tables):
    return arma.classified(materialize(_weekly(t), "weekly"), "series", "week", "y")


@query(
    "ts_stored_model",
    f"""WITH {WEEKLY_SQL}, h AS (SELECT series, week, y, row_number() OVER (PARTITION BY series ORDER BY week) - 1 AS i FROM w WHERE week < TIMESTAMP '1999-01-04'),
    m AS (SELECT series, avg(y) AS mean, count(*) AS n, least(1 + CAST(ceil(pow(ln(greatest(count(*), 2)), 1.5)) AS BIGINT), greatest(count(*) // 4, 1)) AS start FROM h GROUP BY 1),
    d AS (SELECT h.*, y - mean AS x, lag(y - mean) OVER (PARTITION BY series ORDER BY week) AS b, start, mean FROM h JOIN m USING (series)),
    f AS (SELECT series, any_value(mean) AS mean, regr_slope(x, b) AS ar, regr_intercept(x, b) AS c FROM d WHERE i >= start GROUP BY 1),
    l AS (SELECT *, lag(y) OVER (PARTITION BY series ORDER BY week) AS earlier FROM w)
    SELECT series, week, round(mean + c + ar * (earlier - mean), 2) AS predicted, round(y, 2) AS actual FROM l JOIN f USING (series)
    WHERE week >= TIMESTAMP '1999-01-04'""",
)
def ts_stored_model(t: Tables):
    """Models of the weeks before 1999, stored, and the later weeks run through them without a refit; the carried models are
    stored again, for the next weeks."""
    weekly = materialize(_weekly(t), "weekly")
    stored = materialize(arma.fit_models(weekly.where(F.col("week") < _moment("1999-01-04")), "series", "week", "y", 1, 0), "models")
    carried = materialize(arma.carry_models(stored, weekly, "series", "week", "y"), "carried")
    later = arma.carried_steps(carried, "series", "week").where(F.col("week") >= _moment("1999-01-04"))
    return later.select("series", "week", F.round("predicted", 2).alias("predicted"), F.round("actual", 2).alias("actual"))


@query("ts_subset_forecast")
def ts_subset_forecast(t: Tables):
    """All priorities at once, with a level change in one of them."""
    parts = decompose(
        _weekly(t), "series", "week", "y", "exo", _regressor(t).withColumnRenamed("day", "week"), _moment("2001-07-30"), cap=1e6,
        lifted=["2-HIGH"], change=_moment("1996-01-01"), change_end=_moment("1997-12-31"), shift_days=1,
    )
    return export_frame(forecast_all(parts, "series", "week"), "series", "week", "y")


def _daily(t: Tables):
    return t("orders").groupBy(F.col("o_orderpriority").alias("series"), F.col("o_orderdate").alias("ds")).agg(
        F.floor((F.sum("o_totalprice") + 0.005) / 1000).cast("double").alias("y")
    )


@query(
    "future_dates",
    """SELECT o_orderpriority AS series, o_orderdate AS ds FROM orders GROUP BY 1, 2 UNION ALL SELECT series, CAST(z + INTERVAL 1 DAY * i AS TIMESTAMP)
    FROM (SELECT o_orderpriority AS series, max(o_orderdate) AS z FROM orders GROUP BY 1), range(1, 366) r(i)""",
)
def future_dates(t: Tables):
    return additive.future_dates(_daily(t), "series", "ds", 365)


def _components(t: Tables):
    daily = materialize(_daily(t), "daily")
    return additive.components(additive.future_dates(daily, "series", "ds", 365), additive.fit(daily, "series", "ds", "y"), "series", "ds")


@query("additive_forecast")
def additive_forecast(t: Tables):
    return additive.predict(_components(t), "series", "ds")


@query("forecast_components")
def forecast_components(t: Tables):
    return additive.long_components(_components(t), "series", "ds")


@query(
    "asof_join",
    """WITH c AS (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY 1, 2),
    k AS (SELECT user_id, ts, event_id, value FROM events JOIN c USING (user_id, ts, event_id))
    SELECT e.event_id, e.user_id, e.ts, k.event_id AS click_event_id, k.ts AS click_ts, k.value AS click_value
    FROM events AS e ASOF LEFT JOIN k ON e.user_id = k.user_id AND e.ts >= k.ts""",
)
def asof_join_query(t: Tables):
    """Every event with its user's latest click that is not later."""
    clicks = t("events").where("event_type = 'click'").select("user_id", "ts", "event_id", "value")
    return asof_join(t("events").select("event_id", "user_id", "ts"), clicks, ["user_id"], "ts", ties=["event_id"], prefix="click_")


@query(
    "asof_hot_key",
    """WITH c AS (SELECT ts, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY 1),
    k AS (SELECT ts, event_id FROM events JOIN c USING (ts, event_id))
    SELECT e.event_id, k.event_id AS error_event_id, k.ts AS error_ts FROM events AS e ASOF LEFT JOIN k ON e.ts >= k.ts""",
)
def asof_hot_key(t: Tables):
    """Every event with the latest error of anybody: all rows share one key."""
    one = F.lit(1).alias("everybody")
    errors = t("events").where("event_type = 'error'").select(one, "ts", "event_id")
    found = asof_join(t("events").select(one, "event_id", "ts"), errors, ["everybody"], "ts", ties=["event_id"], prefix="error_")
    return found.select("event_id", "error_event_id", "error_ts")
