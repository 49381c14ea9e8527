import random

import numpy as np
import pytest
from conftest import rows
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from caseloom.operators import events, ml
from caseloom.operators.clean import column_profile, merge_profiles, profile_state
from caseloom.registry.core import Tables


@pytest.fixture(scope="module")
def log(spark):
    """One case holds a third of the events."""
    rng = random.Random(5)
    data = [("hot" if i % 3 == 0 else f"c{rng.randrange(60)}", rng.choice("abc"), i // 2, i) for i in range(1500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "case string, act string, at int, id int")
    df = df.withColumn("ts", F.timestamp_seconds("at").cast("timestamp_ntz"))
    return events.EventLog(df, "case", "act", "ts", "id"), data


def sequences(data):
    cases = {}
    for case, act, at, i in sorted(data, key=lambda r: (r[2], r[3])):
        cases.setdefault(case, []).append(act)
    return cases


@pytest.mark.parametrize("group_rows", [10**6, 20])
def test_variants(log, group_rows):
    bound, data = log
    got = {r.case: r.variant for r in events.case_variants(bound, ">", group_rows=group_rows).collect()}
    assert got == {c: ">".join(s) for c, s in sequences(data).items()}


def test_long_cases_come_in_whole_parts(log):
    bound, data = log
    parts = events.case_variants(bound, ">", part_events=7).where("case = 'hot'").orderBy("part").collect()
    assert [len(p.variant.split(">")) for p in parts] == [7] * 71 + [3]
    assert ">".join(p.variant for p in parts) == ">".join(sequences(data)["hot"])


@pytest.mark.parametrize("part_events", [10_000, 2])
def test_variant_counts(spark, part_events):
    data = [("x", "a", 1), ("x", "b", 2), ("y", "b", 2), ("y", "a", 1), ("z", "b", 1), ("z", "a", 2), ("w", "a", 1), ("v", "abab", 1)]
    data += [(c, a, t) for c in ("p", "q") for t, a in enumerate("ababa")]
    df = spark.createDataFrame(data, "case string, act string, ts int").withColumn("ts", F.timestamp_seconds("ts"))
    got = events.variant_counts(events.EventLog(df, "case", "act", "ts"), "", part_events).collect()
    whole = {}
    for r in sorted(got, key=lambda r: r.part):
        whole.setdefault((r.n_cases, r.n_events), []).append((r.part, r.variant))
    assert whole[(2, 5)] == ([(0, "ababa")] if part_events > 5 else [(0, "ab"), (1, "ab"), (2, "a")])
    assert whole[(2, 2)] == [(0, "ab")] and whole[(1, 2)] == [(0, "ba")]
    assert sorted(v for _, v in whole[(1, 1)]) == ["a", "abab"]


@pytest.mark.parametrize("part_events", [10_000, 7, 2, 1])
def test_variant_codes_follow_text_order(log, part_events):
    bound, data = log
    texts = {c: " > ".join(s) for c, s in sequences(data).items()}
    order = {v: i for i, v in enumerate(sorted(set(texts.values())))}
    got = {r.case: r.variant_code for r in events.variant_codes(bound, part_events=part_events).collect()}
    assert got == {c: order[v] for c, v in texts.items()}


@pytest.mark.parametrize("part_events", [10_000, 3, 1])
def test_variant_codes_of_shared_beginnings(spark, part_events):
    variants = ["a", "aa", "a b", "ab", "a!", "a,a", "a,b", "a,b,a", "a,b,a,a,a,a,a,b", "a,b,a,a,a,a,a,c", "a,b,a,a,a,a", "b", "é,a", "a,b,a,a,a,a,a,b,a"]
    data = [(f"{copy}-{v}", act, i) for copy in range(2) for v in variants for i, act in enumerate(v.split(","))]
    df = spark.createDataFrame(data, "case string, act string, ts int").withColumn("ts", F.timestamp_seconds("ts"))
    got = {r.case: r.variant_code for r in events.variant_codes(events.EventLog(df, "case", "act", "ts"), part_events=part_events).collect()}
    order = {v: i for i, v in enumerate(sorted(variants, key=lambda v: v.replace(",", " > ").encode()))}
    assert got == {f"{copy}-{v}": order[v] for copy in range(2) for v in variants}


def test_throughput(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', timestamp_ntz'2020-01-01 00:00:00'), ('a', timestamp_ntz'2020-01-02 12:00:00'), ('b', timestamp_ntz'2020-01-01') AS t(c, ts)")
    got = events.throughput_days(events.EventLog(df, "c", "c", "ts"))
    assert rows(got.select("c", "throughput_days")) == [("a", 1.5), ("b", 0.0)]


# Learning


def test_labels_and_dummies(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",), (None,)], "v string")
    assert rows(ml.label_encode(df, "v")) == sorted([("b", 1), ("a", 0), ("c", 2), ("a", 0), (None, None)], key=repr)
    assert rows(ml.one_hot(df, "v")) == sorted([(1, 0), (0, 0), (0, 1), (0, 0), (0, 0)])
    assert ml.one_hot(df, "v", drop_first=False).columns == ["v_a", "v_b", "v_c"]


def test_split_is_stable_under_repartition(spark):
    df = spark.range(5000)
    one = {r.id for r in ml.split_hash(df, ["id"]).where("is_train").collect()}
    two = {r.id for r in ml.split_hash(df.repartition(7), ["id"]).where("is_train").collect()}
    assert one == two and abs(len(one) - 3500) < 150


def test_split_where_is_a_partition(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "v int")
    train, test = ml.split_where(df, F.col("v") < 2)
    assert rows(train) == [(1,)] and rows(test) == [(2,), (None,)]


def test_rows_are_at_their_nearest_centre(spark, folder):
    points = ml.array_features(Tables(spark, folder)("embeddings"), "embedding")
    model, clustered = ml.kmeans(points, 5)
    centres = np.array(model.clusterCenters())
    for r in clustered.select(vector_to_array("features").alias("x"), "cluster").collect():
        distances = ((centres - np.array(r.x)) ** 2).sum(axis=1)
        assert distances[r.cluster] <= distances.min() + 1e-9
    assert ml.centroids(clustered).count() == 5 * 64


def test_svd_matches_numpy(spark, folder):
    points = ml.array_features(Tables(spark, folder)("embeddings"), "embedding").select("vec_id", "features")
    scored, shares = ml.truncated_svd(points)
    got = scored.orderBy("vec_id").select(vector_to_array("features").alias("x"), "component_0", "component_1").collect()
    x = np.array([r.x for r in got])
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    for j in range(2):
        mine = np.array([r[f"component_{j}"] for r in got])
        assert np.allclose(np.abs(mine), np.abs(u[:, j] * s[j]), atol=1e-6)
    want = [(u[:, j] * s[j]).var() / x.var(axis=0).sum() for j in range(2)]
    assert np.allclose([r.variance_share for r in shares.orderBy("component").collect()], want, rtol=1e-6)


@pytest.fixture(scope="module")
def learning_frame(spark):
    rng = random.Random(1)
    data = []
    for i in range(800):
        a, b = rng.random(), rng.random()
        data.append((i, a, b, 3 * a + (1 if b > 0.5 else 0), int(a > 0.5), None if i % 10 == 0 else float(a > 0.5)))
    df = spark.createDataFrame(data, "k int, a double, b double, y double, c int, target double")
    return ml.assemble(df, ["a", "b"]).persist()


def test_regression_and_history(learning_frame):
    model = ml.fit_regressor(learning_frame, "y", featureSubsetStrategy="all")
    history = ml.evaluation_history(model, {"train": learning_frame}).orderBy("trees").collect()
    assert len(history) == 30 and history[-1].value < history[0].value < 0.2
    assert ml.evaluation(model.transform(learning_frame), "y", False).first().rmse == pytest.approx(history[-1].value, rel=1e-6)
    importance = ml.feature_importance(model, ["a", "b"], learning_frame).collect()
    assert importance[0].feature == "a" and sum(r.weight for r in importance) == pytest.approx(1)


def test_classification_export_and_save(spark, learning_frame, tmp_path):
    known, unknown = ml.known_rows(learning_frame, "target"), ml.forecast_rows(learning_frame, "target")
    split = ml.split_hash(known, ["k"])
    test = split.where("not is_train")
    model = ml.fit_classifier(split.where("is_train"), "target", maxIter=5, maxDepth=3)
    history = ml.evaluation_history(model, {"test": test}).orderBy("trees").collect()
    scored = ml.score(model, test, ["k"]).join(test.select("k", "target"), "k")
    assert ml.evaluation(scored, "target", True).first().log_loss == pytest.approx(history[-1].value, rel=1e-6)
    out = ml.prediction_export(model, test, unknown, ["k"], "target", ["a"], {"a": "first_input"})
    counts = {r.subset: r["count"] for r in out.groupBy("subset").count().collect()}
    assert counts == {"Test": test.count(), "Forecast": 80}
    assert out.where("subset = 'Forecast' AND target IS NOT NULL").count() == 0
    assert {"k", "prediction", "proba_prediction", "target", "first_input", "subset"} == set(out.columns)
    path = ml.save_model(model, str(tmp_path), "boosted", "2024-01-02")
    again = type(model).load(path)
    assert rows(ml.score(again, test, ["k"])) == rows(ml.score(model, test, ["k"]))


def test_sparse_one_hot_of_many_values(spark):
    many = spark.range(300_000).selectExpr("id", "concat('v', lpad(id, 6, '0')) AS v", "1 AS code")
    known = ml.categories(many, "v")
    later = spark.createDataFrame([(0, "v000000"), (1, "v000001"), (2, "v299999"), (3, "new"), (4, None)], "id int, v string")
    places = ml.one_hot_sparse(later, "v", known).select("id", ml.sparse_places("features").alias("p")).orderBy("id").collect()
    assert [r.p for r in places] == [[], [0], [299_998], [], []]
    first = ml.one_hot_sparse(many, "v", known, drop_first=False)
    assert first.columns == ["id", "code", "features"]
    assert first.where(ml.sparse_places("features")[0] == F.col("id")).count() == 300_000
    assert ml.one_hot_sparse(later, "v", known).first().features.size == 299_999
    with pytest.raises(ValueError, match="values"):
        ml.one_hot(many, "v")
    assert ml.one_hot(later, "v", values=["a", "new"]).columns == ["id", "v_new"]


def test_merged_profiles(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumn("gap", F.nullif("o_orderstatus", F.lit("O")))
    states = [profile_state(orders.where(F.col("o_orderkey") % 3 == part)) for part in range(3)]
    merged = {r.column: r for r in merge_profiles(states[0].unionByName(states[1]).unionByName(states[2])).collect()}
    exact = {r.column: r for r in column_profile(orders).collect()}
    assert merged.keys() == exact.keys() == set(orders.columns)
    for name, want in exact.items():
        got = merged[name]
        assert (got.type, got.n, got.nulls) == (want.type, want.n, want.nulls)
        assert abs(got.distinct - want.distinct) <= 0.03 * want.distinct
    assert exact["gap"].nulls == orders.where("o_orderstatus = 'O'").count()
    assert "Expand" not in column_profile(orders)._jdf.queryExecution().executedPlan().toString()
