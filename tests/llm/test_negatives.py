"""Hard negatives against a plain search over all pairs."""

import math
import random

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm import negatives
from caseloom.llm.registry import ORACLES, QUERIES


def test_against_sql(spark, folder):
    from oracle import compare, connect

    for where in (folder, folder.replace("sf0.001", "sf0.01")):
        found = [p for p in compare(spark, connect(where), QUERIES["op12_hard_negatives"], ORACLES["op12_hard_negatives"], where) if not p.startswith("plan has")]
        assert found == []


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 20), st.integers(1, 6), st.integers(1, 6), st.sampled_from([1, 2, 200, 40_000, 2**40, 2**70]), st.integers(0, 2**32 - 1))
def test_scores_are_exact(dim, n, m, reach, seed):
    draw = random.Random(seed)
    a, c = ([[draw.randint(-reach, reach) for _ in range(dim)] for _ in range(k)] for k in (n, m))
    kind = np.int64 if reach < 2**62 else object
    anchors, rows = (np.array(x, dtype=kind).reshape(len(x), dim) for x in (a, c))
    got = negatives.exact_scores(anchors, negatives.bit_planes(rows))
    assert [[int(x) for x in line] for line in got.T] == [[sum(x * y for x, y in zip(p, q)) for q in c] for p in a]


def test_planes_and_sums():
    planes = negatives.bit_planes(np.array([[5, -1, 0], [-8, 7, 2]]))
    assert planes.shape == (4, 1, 2)
    back = sum((np.unpackbits(planes[j], axis=0, bitorder="little").astype(int) << j) * (-1 if j == 3 else 1) for j in range(4))
    assert back[:3].T.tolist() == [[5, -1, 0], [-8, 7, 2]]
    table = negatives.subset_sums(np.array([[1, 10, 100]]), np.int64)
    assert table.shape == (1, 256, 1) and table[0, 0b101, 0] == 101 and table[0, 0b11111000, 0] == 0
    big = negatives.whole_components(pa.array([[1e300, -1e18]], pa.list_(pa.float64())), 256)
    assert big.dtype == object and big[0, 0] == int(np.floor(1e300 * 256))


def brute(rows, positives=5, count=3):
    whole = [(i, g, tuple(math.floor(256 * x) for x in v)) for i, g, v in rows
             if i is not None and g is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = sorted(set(whole))
    out = []
    for i, g, q in whole:
        if i % 50:
            continue
        score = lambda v: sum(a * b for a, b in zip(q, v))  # noqa: E731, B023
        others = [(score(v), j, h) for j, h, v in whole if j != i and len(v) == len(q)]
        best = sorted(((s, j) for s, j, h in others if h == g), key=lambda x: (-x[0], x[1]))[:positives]
        for rank, (s, j) in enumerate(best, 1):
            inside = sorted(((t, k) for t, k, h in others if h != g and 50 * s <= 100 * t <= 95 * s), key=lambda x: (-x[0], x[1]))[:count]
            out += [(i, j, r, k, s, t, rank) for r, (t, k) in enumerate(inside, 1)]
    return sorted(out)


def test_edge_cases(spark):
    draw = random.Random(9)
    center = {g: [draw.gauss(0, 1) for _ in range(19)] for g in range(4)}
    rows = [(i, i % 4 if i % 3 else 0, [x + draw.gauss(0, 0.8) for x in center[i % 4]]) for i in range(400)]
    rows += [(i, i % 2, [0.5] * 19) for i in range(400, 520)]  # ties
    rows += [(i, 1, [0.0] * 19) for i in range(550, 560)] + [(600, 1, [-1.0] * 19), (650, 9, [1.0] * 19)]
    rows += [(700, None, [1.0] * 19), (701, 1, None), (702, 1, [None] * 19), (703, 1, [float("nan")] * 19), (704, 2, [float("inf")] * 19), (None, 1, [1.0] * 19)]
    rows += [(750, 1, []), (751, 1, []), (752, 2, []), (800, 1, [1.0, 2.0]), (801, 1, [1.0, 2.5]), (802, 3, [0.9, 1.0])]
    rows += [rows[0], rows[7], (50, 0, [0.25] * 19), (850, 5, [3e5] * 19), (851, 5, [2e6] * 19), (852, 6, [1.5e6] * 19)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id bigint, label int, embedding array<double>, rank int, mark string, dim int")
    anchors = frame.where("vec_id % 50 = 0")
    want = brute(rows)
    assert any(r[0] == 850 for r in want) and len(want) > 60
    for a, c in ((3, 37), (1024, 4096)):
        got = negatives.hard_negatives(frame, anchors, anchor_block=a, candidate_block=c)
        names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank"]
        assert sorted(tuple(r[n] for n in names) for r in got.collect()) == want
    assert negatives.hard_negatives(frame.limit(0), anchors.limit(0)).collect() == []
    assert negatives.hard_negatives(frame, anchors.limit(0)).collect() == []


def test_blocks_are_not_broadcast(spark):
    """A block of anchors is repeated for every block of candidates: sent whole through the driver, that grows with the square of the table."""
    rows = [(i, i % 3, [float((i * j) % 7 - 3) for j in range(1, 9)]) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<double>")
    plans, packed = [], negatives._meet

    def meet(left, right, keys):
        plans.append(packed(left, right, keys))
        return plans[-1]

    negatives._meet = meet
    try:
        found = negatives.hard_negatives(frame, frame.where("vec_id % 50 = 0"), anchor_block=4, candidate_block=50)
        assert sorted(tuple(r)[:6] for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()) == sorted(
            r[:6] for r in brute(rows))
    finally:
        negatives._meet = packed
    for cells in plans:
        plan = cells._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [dim" in plan and not any("BroadcastHashJoin" in line and " a#" in line for line in plan.splitlines())
