import random
import re

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from caseloom.operators import ordered
from caseloom.operators.relational import top_n
from caseloom.session import clear_scratch, materialize, shared_dir


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belongs to one key; one key is null."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 50 == 1 else f"k{rng.randrange(40)}")
        data.append((key, i, None if rng.random() < 0.1 else float(rng.randrange(100))))
    rng.shuffle(data)
    return spark.createDataFrame(data, "key string, at int, value double").repartition(6)


def test_position_is_contiguous_and_ordered(skewed):
    placed = ordered.with_position(skewed, [F.desc("at")]).orderBy("position").collect()
    assert [r.position for r in placed] == list(range(3000))
    assert [r["at"] for r in placed] == list(range(2999, -1, -1))


def test_position_of_empty_frame(skewed):
    assert ordered.with_position(skewed.where("at < 0"), "at").count() == 0


def test_group_position_blocked_equals_window(skewed):
    plain = ordered.with_group_position(skewed, ["key"], "at")
    spread = ordered.with_group_position(skewed, ["key"], "at", group_rows=10)
    assert rows(plain.select("at", "position")) == rows(spread.select("at", "position"))


@pytest.mark.parametrize("window,center,periods", [(7, False, None), (10, True, None), (5, True, 1), (12, False, 1), (52, False, None)])
def test_blocked_rolling_mean_equals_window_and_pandas(skewed, window, center, periods):
    args = dict(keys=["key"], center=center, min_periods=periods, name="m")
    plain = ordered.rolling_mean(skewed, "value", "at", window, **args)
    blocked = ordered.rolling_mean(skewed, "value", "at", window, group_rows=20, block_rows=64, **args)
    assert rows(plain.select("key", "at", F.round("m", 9))) == rows(blocked.select("key", "at", F.round("m", 9)))
    pdf = skewed.where("key = 'hot'").toPandas().sort_values("at")
    want = pdf["value"].rolling(window, center=center, min_periods=periods).mean().tolist()
    got = [r.m for r in blocked.where("key = 'hot'").orderBy("at").collect()]
    assert all((pd.isna(w) and g is None) or abs(w - g) < 1e-9 for w, g in zip(want, got, strict=True))


def test_rolling_mean_without_keys_is_blocked_too(skewed):
    plain = ordered.rolling_mean(skewed, "value", "at", 9, min_periods=1, name="m").select("at", F.round("m", 9))
    blocked = ordered.rolling_mean(skewed, "value", "at", 9, min_periods=1, name="m", group_rows=1, block_rows=100)
    assert rows(plain) == rows(blocked.select("at", F.round("m", 9)))


@pytest.mark.parametrize("periods", [-3, -1, 1, 4])
def test_blocked_shift(skewed, periods):
    plain = ordered.shift_rows(skewed, "at", "at", periods, ["key"])
    blocked = ordered.shift_rows(skewed, "at", "at", periods, ["key"], group_rows=5, block_rows=16)
    assert rows(plain.select("at", "shifted")) == rows(blocked.select("at", "shifted"))


def test_constant_series_has_constant_mean(spark):
    df = spark.range(200).select("id", F.lit(4.0).alias("v"))
    assert {r.m for r in ordered.rolling_mean(df, "v", "id", 20, min_periods=1, name="m").collect()} == {4.0}


def test_drop_last(skewed):
    left = ordered.drop_last(skewed, ["at"], 5)
    assert sorted(r["at"] for r in left.collect()) == list(range(2995))


def test_drop_last_of_tied_rows(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "at int")
    assert sorted(r["at"] for r in ordered.drop_last(df, ["at"], 1).collect()) == [1, 2]


def test_zip_keeps_the_longer_side(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, x string")
    b = spark.createDataFrame([(10,), (20,)], "y int")
    zipped = ordered.zip_by_order(a, b, ["n"], [F.desc("y")])
    assert [(r.x, r.y) for r in zipped.orderBy("position").collect()] == [("a", 20), ("b", 10), ("c", None)]


def test_order_is_required(skewed):
    with pytest.raises(ValueError):
        ordered.with_position(skewed, [])


def test_top_n_limits_groups_before_the_shuffle(skewed):
    few = top_n(skewed, ["key"], [F.desc("at")], 2)
    assert "WindowGroupLimit" in few._jdf.queryExecution().executedPlan().toString()
    many = top_n(skewed, ["key"], [F.desc("at")], 1_001).where("rank <= 2")
    assert rows(few.select("at", "rank")) == rows(many.select("at", "rank"))


def test_scratch_can_be_cleared(spark):
    kept = materialize(spark.range(5))
    assert kept.count() == 5 and shared_dir(spark)
    clear_scratch(spark)
    assert materialize(spark.range(3)).count() == 3


def test_hot_group_is_spread_over_blocks(skewed):
    """Only the hot key leaves the plain window, and its rows are shuffled by block as well as key."""
    rest, hot = ordered.split_hot(skewed, ["key"], 900)
    assert {r.key for r in hot.select("key").distinct().collect()} == {"hot"}
    assert rest.count() + hot.count() == 3000
    mixed = ordered.rolling_mean(skewed, "value", "at", 7, ["key"], min_periods=1, name="m", group_rows=900, block_rows=50)
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(key#\d+, __block#\d+", plan)
    plain = ordered.rolling_mean(skewed, "value", "at", 7, ["key"], min_periods=1, name="m")
    assert rows(mixed.select("at", F.round("m", 9))) == rows(plain.select("at", F.round("m", 9)))
