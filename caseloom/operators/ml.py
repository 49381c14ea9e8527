"""Encoding, splitting, clustering and boosted trees on DataFrames and Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.ordered import with_position
from caseloom.operators.relational import enrich_left, tagged_union
from caseloom.session import BROADCAST_ROWS, broadcast_if_small

# Values that may become columns.
WIDE_VALUES = 10_000


def label_encode(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """0-based code of each value in sort order; nulls stay null. Only the distinct values are ordered."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = broadcast_if_small(with_position(values, column, name))
    return df.join(codes, column, "left").select(*df.columns, name)


def one_hot(df: DataFrame, column: str, drop_first: bool = True, values: Sequence | None = None) -> DataFrame:
    """0/1 columns ``column_value``, without the first. Null and unlisted values are 0 everywhere.

    ``values`` lists the values; without it one pass finds them, in sort order. They become columns, so more than
    ``WIDE_VALUES`` found values are an error: encode those with ``one_hot_sparse``.
    """
    if values is None:
        found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(WIDE_VALUES + 1).collect()
        if len(found) > WIDE_VALUES:
            raise ValueError(f"{column!r} has more than {WIDE_VALUES} values")
        values = sorted(r[0] for r in found)
    flags = [F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in values[1 if drop_first else 0 :]]
    return df.select(*[c for c in df.columns if c != column], *flags)


def categories(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Table of the values of a column and their 0-based codes in sort order; it can be stored and used for later rows."""
    return with_position(df.select(column).where(F.col(column).isNotNull()).distinct(), column, name)


def one_hot_sparse(df: DataFrame, column: str, known: DataFrame, name: str = "features", drop_first: bool = True,
                   code: str = "code") -> DataFrame:
    """The column as a sparse 0/1 vector over the values of a ``categories`` table, for any number of values.

    A value's place is its code, less one without the first. Nulls, values that the table lacks and, if it is dropped, the
    first value are vectors of zeros. Only the number of values reaches the driver.
    """
    first = 1 if drop_first else 0
    size = known.count() - first
    if size < 1:
        raise ValueError(f"no values of {column!r} to encode")
    codes = F.broadcast(known) if size < BROADCAST_ROWS else known
    place = F.col(f"__known.{code}") - first
    coded = df.join(codes.withColumnRenamed(column, "__value").alias("__known"), F.col(column) == F.col("__known.__value"), "left").select(
        *[df[c] for c in df.columns], F.when(place >= 0, place).otherwise(size).cast("double").alias("__place")
    )
    # The place after the last is that of unknown values, which the encoder drops.
    encoder = OneHotEncoder(inputCol="__place", outputCol=name, handleInvalid="keep", dropLast=True)
    last = df.sparkSession.range(1).select(F.lit(size - 1.0).alias("__place"))
    return encoder.fit(last).transform(coded).drop("__place", column)


def sparse_places(c: str) -> Column:
    """Places of the entries of a sparse vector, without making it dense."""
    fields = F.from_json(F.to_json(F.struct(F.col(c).alias("v"))), "v struct<indices:array<int>>")
    return fields["v"]["indices"]


def forecast_rows(df: DataFrame, target: str) -> DataFrame:
    """Rows to predict: the target is unknown."""
    return df.where(F.col(target).isNull())


def known_rows(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def split_where(df: DataFrame, train: Column) -> tuple[DataFrame, DataFrame]:
    """Train rows and the rest by a date or value condition; rows where it is unknown are in the rest."""
    return df.where(train), df.where(~F.coalesce(train, F.lit(False)))


def split_bucket(keys: Sequence[str], seed: int = 42) -> Column:
    """0..99 from a hash of the key columns: the same row gets the same bucket under any partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def split_hash(df: DataFrame, keys: Sequence[str], train_percent: int = 70, seed: int = 42) -> DataFrame:
    """Random split that does not depend on row order: a boolean ``is_train``."""
    return df.withColumn("is_train", split_bucket(keys, seed) < train_percent)


def assemble(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def array_features(df: DataFrame, column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(column).cast("array<double>")))


def kmeans(df: DataFrame, k: int = 5, seed: int = 100, features: str = "features", name: str = "cluster"):
    """Fitted model and the rows with their cluster."""
    model = KMeans(k=k, seed=seed, featuresCol=features, predictionCol=name).fit(df)
    return model, model.transform(df)


def centroids(df: DataFrame, features: str = "features", name: str = "cluster") -> DataFrame:
    """Mean vector per cluster in long form."""
    means = df.groupBy(name).agg(vector_to_array(Summarizer.mean(F.col(features))).alias("__m"))
    return means.select(name, F.posexplode("__m").alias("dimension", "value"))


def truncated_svd(df: DataFrame, features: str = "features", k: int = 2) -> tuple[DataFrame, DataFrame]:
    """Rows with ``k`` uncentred component scores, and the share of variance of each component.

    Only the small right-hand matrix reaches the driver; rows are projected by an array expression. The sign of a
    component is fixed so that its largest weight is positive.
    """
    old_vectors = MLUtils.convertVectorColumnsFromML(df.select(features), features)
    v = RowMatrix(old_vectors).computeSVD(k, computeU=False).V.toArray()
    values = vector_to_array(features)
    scores = []
    for j in range(k):
        weights = v[:, j] if abs(v[:, j].max()) >= abs(v[:, j].min()) else -v[:, j]
        weighted = F.zip_with(values, F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
        scores.append(F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x).alias(f"component_{j}"))
    scored = df.select("*", *scores)
    total = F.aggregate(vector_to_array(Summarizer.variance(F.col(features))), F.lit(0.0), lambda a, x: a + x)
    shares = scored.agg(total.alias("__total"), *[F.var_samp(f"component_{j}").alias(f"v{j}") for j in range(k)])
    rows = [F.struct(F.lit(j).alias("component"), (F.col(f"v{j}") / F.col("__total")).alias("variance_share")) for j in range(k)]
    return scored, shares.select(F.inline(F.array(*rows)))


def fit_regressor(train: DataFrame, label: str, features: str = "features", **params) -> GBTRegressionModel:
    """Boosted regression trees: depth 5, rate 0.1, 30 trees, 80 % of the columns per split. Spark ML has no L1 term."""
    settings = dict(maxDepth=5, stepSize=0.1, maxIter=30, featureSubsetStrategy="0.8", seed=42) | params
    return GBTRegressor(featuresCol=features, labelCol=label, predictionCol="prediction", **settings).fit(train)


def fit_classifier(train: DataFrame, label: str, features: str = "features", **params) -> GBTClassificationModel:
    """Boosted classification trees: depth 8, rate 0.1, 30 trees, all rows."""
    settings = dict(maxDepth=8, stepSize=0.1, maxIter=30, subsamplingRate=1.0, seed=42) | params
    return GBTClassifier(featuresCol=features, labelCol=label, predictionCol="prediction", **settings).fit(train)


def evaluation_history(model, sets: Mapping[str, DataFrame]) -> DataFrame:
    """Metric after each tree on each named set: RMSE for regression, log loss for classification.

    Evaluation rows only report; they do not stop the fit early.
    """
    rows = []
    for name, df in sets.items():
        if isinstance(model, GBTRegressionModel):
            losses = [("rmse", float(v) ** 0.5) for v in model.evaluateEachIteration(df, "squared")]
        else:
            losses = [("log_loss", float(v) / 2) for v in model.evaluateEachIteration(df)]
        rows += [(name, i + 1, metric, value) for i, (metric, value) in enumerate(losses)]
    session = next(iter(sets.values())).sparkSession
    return session.createDataFrame(rows, "subset string, trees int, metric string, value double")


def score(model, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key, prediction and, for a classifier, the probability of class 1."""
    scored = model.transform(df)
    columns = [*keys, F.col("prediction")]
    if "probability" in scored.columns:
        columns.append(vector_to_array("probability")[1].alias("proba_prediction"))
    return scored.select(*columns)


def evaluation(df: DataFrame, label: str, classifier: bool) -> DataFrame:
    """RMSE, or log loss of the class-1 probability."""
    if not classifier:
        return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), 2))).alias("rmse"))
    p = F.greatest(F.least(F.col("proba_prediction"), F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -F.when(F.col(label) == 1, F.log(p)).otherwise(F.log(1 - p))
    return df.agg(F.avg(loss).alias("log_loss"))


def feature_importance(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Feature weights of a fitted tree model, heaviest first."""
    rows = [(n, float(model.featureImportances[i])) for i, n in enumerate(names)]
    return df.sparkSession.createDataFrame(rows, "feature string, weight double").orderBy(F.desc("weight"), "feature")


def prediction_export(
    model,
    test: DataFrame,
    forecast: DataFrame,
    keys: Sequence[str],
    target: str,
    inputs: Sequence[str],
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Scored test and forecast rows with their inputs and a ``subset`` column; forecast rows have no true value."""
    scored_test = score(model, test, [*keys, target, *inputs])
    scored_forecast = score(model, forecast, [*keys, *inputs])
    both = tagged_union({"Test": scored_test, "Forecast": scored_forecast}, "subset")
    return both.withColumnsRenamed(dict(names or {}))


def save_model(model, folder: str, name: str, date: str) -> str:
    """Save under a dated path, replacing an older save of that date."""
    path = f"{folder.rstrip('/')}/{name}_{date}"
    model.write().overwrite().save(path)
    return path
