"""Queries over encoding, splits, clustering and boosted trees."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from caseloom.operators import ml
from caseloom.operators.ordered import rolling_mean
from caseloom.registry.core import Tables, query
from caseloom.session import materialize, scratch_path


@query("label_encode", "SELECT event_id, dense_rank() OVER (ORDER BY event_type) - 1 AS code FROM events")
def label_encode(t: Tables):
    return ml.label_encode(t("events").select("event_id", "event_type"), "event_type").select("event_id", "code")


@query(
    "one_hot",
    """SELECT event_id, CAST(event_type = 'error' AS INTEGER) AS event_type_error, CAST(event_type = 'purchase' AS INTEGER) AS event_type_purchase,
    CAST(event_type = 'signup' AS INTEGER) AS event_type_signup, CAST(event_type = 'view' AS INTEGER) AS event_type_view FROM events""",
)
def one_hot(t: Tables):
    return ml.one_hot(t("events").select("event_id", "event_type"), "event_type")


@query(
    "one_hot_sparse",
    "SELECT event_id, CASE WHEN p >= 0 THEN p END AS place FROM (SELECT event_id, CAST(dense_rank() OVER (ORDER BY user_id) - 2 AS INTEGER) AS p FROM events)",
)
def one_hot_sparse(t: Tables):
    """Users as sparse vectors without the first: the place of the one."""
    events = t("events").select("event_id", "user_id")
    encoded = ml.one_hot_sparse(events, "user_id", ml.categories(events, "user_id"))
    return encoded.select("event_id", F.get(ml.sparse_places("features"), F.lit(0)).alias("place"))


@query("forecast_mask", "SELECT o_orderkey, o_orderdate FROM orders WHERE nullif(o_orderstatus, 'O') IS NULL")
def forecast_mask(t: Tables):
    marked = t("orders").withColumn("target", F.nullif("o_orderstatus", F.lit("O")))
    return ml.forecast_rows(marked, "target").select("o_orderkey", "o_orderdate")


@query("split_by_date", "SELECT o_orderkey, o_orderdate < TIMESTAMP '2000-02-10' AS is_train FROM orders")
def split_by_date(t: Tables):
    train, test = ml.split_where(t("orders").select("o_orderkey", "o_orderdate"), F.col("o_orderdate") < F.lit("2000-02-10").cast("timestamp_ntz"))
    return train.select("o_orderkey", F.lit(True).alias("is_train")).unionByName(test.select("o_orderkey", F.lit(False).alias("is_train")))


@query("split_hash", "SELECT o_orderkey, CAST(concat('0x', substr(md5('42|' || o_orderkey), 1, 8)) AS BIGINT) % 100 < 70 AS is_train FROM orders")
def split_hash(t: Tables):
    return ml.split_hash(t("orders"), ["o_orderkey"]).select("o_orderkey", "is_train")


def _points(t: Tables):
    return ml.array_features(t("embeddings"), "embedding").select("vec_id", "label", "features")


@query("kmeans_assign")
def kmeans_assign(t: Tables):
    _, clustered = ml.kmeans(_points(t), 5)
    return clustered.select("vec_id", "cluster")


@query("kmeans_centroids")
def kmeans_centroids(t: Tables):
    _, clustered = ml.kmeans(_points(t), 5)
    return ml.centroids(clustered)


@query("svd_2d")
def svd_2d(t: Tables):
    scored, _ = ml.truncated_svd(_points(t))
    return scored.select("vec_id", "component_0", "component_1")


@query("svd_variance")
def svd_variance(t: Tables):
    _, shares = ml.truncated_svd(_points(t))
    return shares


LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size", "l_returnflag_N", "l_returnflag_R"]


def _line_frame(t: Tables):
    """Line items with part columns and flags; the price is unknown for shipments after 2001."""
    joined = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    frame = ml.one_hot(joined.select(*LINE_KEYS, "l_quantity", "l_discount", "l_tax", "p_retailprice", "p_size", "l_returnflag",
                                     "l_shipdate", "l_extendedprice"), "l_returnflag")
    price = F.when(F.col("l_shipdate") < F.lit("2001-01-01").cast("timestamp_ntz"), F.col("l_extendedprice"))
    split = ml.split_hash(frame.withColumn("price", price), LINE_KEYS)
    return materialize(ml.assemble(split, LINE_FEATURES).drop("l_extendedprice"), "lines")


def _line_model(t: Tables):
    frame = _line_frame(t)
    known = ml.known_rows(frame, "price")
    model = ml.fit_regressor(known.where("is_train"), "price")
    return frame, known, model


@query("gbt_regression")
def gbt_regression(t: Tables):
    _, known, model = _line_model(t)
    test = known.where(~F.col("is_train"))
    return ml.score(model, test, LINE_KEYS)


@query("gbt_evaluation")
def gbt_evaluation(t: Tables):
    _, known, model = _line_model(t)
    return ml.evaluation_history(model, {"train": known.where("is_train"), "test": known.where(~F.col("is_train"))})


@query("feature_importance")
def feature_importance(t: Tables):
    _, known, model = _line_model(t)
    return ml.feature_importance(model, LINE_FEATURES, known)


@query("saved_model", "SELECT count(*) = 0 AS any_difference_missing, 0::BIGINT AS different FROM region WHERE r_name IS NULL")
def saved_model(t: Tables):
    """Scores of a model that was saved and loaded again equal those before."""
    _, known, model = _line_model(t)
    test = known.where(~F.col("is_train"))
    again = GBTRegressionModel.load(ml.save_model(model, scratch_path(t.spark, "models"), "price", "2020-01-01"))
    before = ml.score(model, test, LINE_KEYS).withColumnRenamed("prediction", "before")
    both = ml.score(again, before.join(test, LINE_KEYS).select(*LINE_KEYS, "features", "before"), [*LINE_KEYS, "before"])
    counted = both.agg(F.count_if(F.col("prediction") != F.col("before")).alias("different"), F.count(F.lit(1)).alias("n"))
    return counted.select((F.col("n") > 0).alias("any_difference_missing"), "different")


@query("export_subsets", """SELECT l_orderkey, l_linenumber, CASE WHEN l_shipdate < TIMESTAMP '2001-01-01' THEN 'Test' ELSE 'Forecast' END AS subset FROM lineitem
    JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '2001-01-01'""")
def export_subsets(t: Tables):
    """Keys and subset of the exported forecast rows: every row without a known price, once."""
    frame, known, model = _line_model(t)
    test = known.where(~F.col("is_train"))
    out = ml.prediction_export(model, test, ml.forecast_rows(frame, "price"), LINE_KEYS, "price", ["l_quantity", "l_shipdate"])
    return out.where("subset = 'Forecast'").select("l_orderkey", "l_linenumber", "subset")


@query("prediction_export")
def prediction_export(t: Tables):
    frame, known, model = _line_model(t)
    test = known.where(~F.col("is_train"))
    return ml.prediction_export(
        model, test, ml.forecast_rows(frame, "price"), LINE_KEYS, "price", ["l_quantity", "l_shipdate"], {"l_shipdate": "ship_date"}
    )


@query("gbt_classification")
def gbt_classification(t: Tables):
    """Document quality from simple text measures."""
    measured = t("documents").join(t("labels"), "doc_id").select(
        "doc_id", "quality", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", " ")).alias("words"),
        F.size(F.split("text", "\n")).alias("lines"), F.regexp_count("text", F.lit("[0-9]")).alias("digits"),
        F.regexp_count("text", F.lit("[^A-Za-z0-9 ]")).alias("others"),
    )
    names = ["n_chars", "words", "lines", "digits", "others"]
    frame = materialize(ml.assemble(ml.split_hash(measured, ["doc_id"]), names), "measures")
    model = ml.fit_classifier(frame.where("is_train"), "quality")
    return ml.score(model, frame.where(~F.col("is_train")), ["doc_id"])


@query("user_value_features", """SELECT event_id, round(avg(value) OVER w, 6) AS recent_value FROM events
    WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def user_value_features(t: Tables):
    events = t("events").select("event_id", "event_type", "ts", "value")
    recent = rolling_mean(events, "value", ["ts", "event_id"], 7, ["event_type"], min_periods=1, name="recent_value")
    return recent.select("event_id", F.round("recent_value", 6).alias("recent_value"))
