"""As-of joins against a plain search."""

import random

import pytest

from caseloom.operators.asof import asof_join


def plain(left, right):
    out = []
    for k, t, i in left:
        before = [(u, n, v) for c, u, n, v in right if c == k and u is not None and t is not None and u <= t]
        out.append((k, t, i, *max(before, key=lambda r: (r[0], r[1]))) if before else (k, t, i, None, None, None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_against_plain_search(spark, partitions):
    draw = random.Random(partitions)
    keys = ["hot"] * 12 + ["a", "b", None, "only left", "x"]
    left = [(draw.choice(keys), draw.choice([None, *range(300)]), i) for i in range(900)]
    right = [(draw.choice([k for k in keys if k != "only left"]), draw.choice([None, *range(0, 300, 7)]), n, f"v{n}") for n in range(120)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ours = spark.createDataFrame(left, "k string, t int, i int")
        theirs = spark.createDataFrame(right, "k string, t int, n int, v string")
        got = asof_join(ours, theirs, ["k"], "t", ties=["n"])
        assert got.columns == ["k", "t", "i", "right_t", "right_n", "right_v"]
        assert sorted(map(tuple, got.collect()), key=repr) == plain(left, right)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert sorted(map(tuple, asof_join(ours, theirs, ["k"], "t", ties=["n"]).collect()), key=repr) == plain(left, right)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_key_without_right_rows_over_many_tasks(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        left = [("k", t, t) for t in range(500)] + [("l", t, t) for t in range(300)]
        right = [("k", 3, 1, "early"), ("j", 0, 2, "other"), ("l", 299, 3, "late")]
        got = asof_join(spark.createDataFrame(left, "k string, t int, i int"), spark.createDataFrame(right, "k string, t int, n int, v string"), ["k"], "t")
        assert sorted(map(tuple, got.collect()), key=repr) == plain(left, right)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_sides(spark):
    left = spark.createDataFrame([("a", 1, 1)], "k string, t int, i int")
    right = spark.createDataFrame([("a", 1, 1, "x")], "k string, t int, n int, v string")
    assert [tuple(r) for r in asof_join(left, right.limit(0), ["k"], "t").collect()] == [("a", 1, 1, None, None, None)]
    assert asof_join(left.limit(0), right, ["k"], "t").collect() == []
