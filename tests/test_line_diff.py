"""Line differences against a plain longest common subsequence."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.operators.line_diff import align, common_subsequence, diff_counts, line_diff


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


SHORT = st.lists(st.integers(0, 4), max_size=14)


@settings(max_examples=200, deadline=None)
@given(SHORT, SHORT)
def test_common_subsequences(a, b):
    left, right = np.array(a, np.int64), np.array(b, np.int64)
    whole, anchored = common_subsequence(left, right), align(left, right)
    assert len(whole) == longest(a, b)
    for pairs in (whole, anchored):
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=60), st.integers(0, 2**32 - 1))
def test_edited_versions_lose_nothing(lines, seed):
    """Inserted new lines and removed lines only: the alignment is as long as the longest common subsequence."""
    draw = random.Random(seed)
    kept = [x for x in lines if draw.random() < 0.8]
    new = [y for x in kept for y in ([1000 + draw.randrange(9)] if draw.random() < 0.2 else []) + [x]]
    assert len(align(np.array(lines, np.int64), np.array(new, np.int64))) == longest(lines, new) == len(kept)


def test_an_inserted_first_line_is_one_added_row(spark):
    body = "\n".join(["begin", "x = 1", "x = 1", "", "end"] * 40)
    old = spark.createDataFrame([(1, body, "a"), (2, "gone\nlines", "a"), (3, None, "a"), (4, "", "a"), (None, "q\nr", "a"), (6, "é", "a")], "k int, t string, line string")
    new = spark.createDataFrame([(1, "# first\n" + body, "b"), (3, "now", "b"), (4, "", "b"), (5, "new", "b"), (None, "r", "b"), (6, None, "b")], "k int, t string, line string")
    found = line_diff(old, new, "k", "t")
    got = {r.k: (r.n_same, r.n_removed, r.n_added) for r in diff_counts(found, "k").collect()}
    assert got == {1: (200, 0, 1), 2: (0, 2, 0), 3: (0, 0, 1), 4: (1, 0, 0), 5: (0, 0, 1), None: (1, 1, 0), 6: (0, 1, 0)}
    assert [tuple(r) for r in found.where("k = 1 and change <> 'same'").collect()] == [(1, "added", None, 1, "# first")]
    assert [tuple(r) for r in found.where("k is null").orderBy("old_line").collect()] == [(None, "removed", 1, None, "q"), (None, "same", 2, 1, "r")]
    assert line_diff(old.limit(0), new.limit(0), "k", "t").collect() == []


@pytest.mark.parametrize("size", [3000])
def test_long_texts(size):
    draw = random.Random(2)
    lines = [draw.randrange(size // 3) for _ in range(size)]
    new = [x for i, x in enumerate(lines) if i % 7 != 3]
    assert len(align(np.array(lines), np.array(new))) == len(new)
