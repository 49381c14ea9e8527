import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm import suffix


def naive(data):
    return sorted(range(len(data)), key=lambda i: data[i:])


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.binary(max_size=80), st.text("ab", max_size=120).map(str.encode), st.text("abc", min_size=1, max_size=6).map(lambda x: x.encode() * 20)), st.booleans())
def test_suffix_array_and_prefixes(data, by_bucket):
    text = np.frombuffer(data, np.uint8)
    whole = suffix._induce_one_by_one
    if by_bucket:
        suffix._induce_one_by_one = suffix._induce_by_bucket
    try:
        order = suffix.suffix_array(text)
    finally:
        suffix._induce_one_by_one = whole
    assert order.tolist() == naive(data)
    if len(data) > 1:
        shared = suffix.permuted_lcp(text, order.astype(np.int64))
        for a, b in zip(order, order[1:]):
            x, y, n = data[a:], data[b:], 0
            while n < min(len(x), len(y)) and x[n] == y[n]:
                n += 1
            assert shared[b] == n


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=60))
def test_order_of_names(names):
    assert suffix._order_names(np.array(names)).tolist() == sorted(range(len(names)), key=lambda i: names[i:])


def test_large_suffix_array():
    draw = np.random.default_rng(3)
    base = draw.integers(97, 101, 2000).astype(np.uint8)
    text = np.concatenate([base, base[500:], draw.integers(97, 100, 30_000).astype(np.uint8), base])
    order = suffix.suffix_array(text)
    data = text.tobytes()
    assert sorted(order.tolist()) == list(range(len(data)))
    assert all(data[a : a + 4000] <= data[b : b + 4000] for a, b in zip(order, order[1:]))


@settings(max_examples=100, deadline=None)
@given(st.text("abé", max_size=300), st.integers(1, 40))
def test_regions_cover_every_window_once(value, segment):
    data = value.encode()
    first, last, grams = suffix.regions_of(data, segment=segment, window=12, gram=4)
    assert [i for a, b in zip(first, last) for i in range(a, b + 1)] == list(range(max(0, len(data) - 11)))
    one = suffix.regions_of(data, window=12, gram=4)
    seen = {}
    for a, b, g in zip(*one):
        for i in range(a, b + 1):
            assert seen.setdefault(data[i : i + 12], g) == g


def corpus():
    draw = random.Random(9)
    letters = "abcdefghij é"
    make = lambda n: "".join(draw.choices(letters, k=n))
    passage, texts = make(90), []
    for i in range(60):
        text = make(draw.randrange(0, 300))
        if i % 4 == 0:
            at = draw.randrange(len(text) + 1)
            text = text[:at] + passage[draw.randrange(20) : draw.randrange(60, 90)] + text[at:]
        texts.append(text)
    texts += [texts[1], texts[1], texts[2][:-1] + "X", None, "", "ab" * 400, "x" * 900, "short", texts[6] + texts[6], "é" * 300]
    rows = list(enumerate(texts))
    return rows + [rows[5], (None, texts[9]), (5, texts[10])]


def brute(rows, window):
    data = [(t or "").encode() for _, t in rows]
    seen = {}
    for row, d in enumerate(data):
        for i in range(len(d) - window + 1):
            seen.setdefault(d[i : i + window], []).append((row, i))
    marks = [np.zeros(len(d), bool) for d in data]
    for places in seen.values():
        if len(places) > 1:
            for row, i in places:
                marks[row][i : i + window] = True
    out = []
    for (key, _), d, m in zip(rows, data, marks):
        spans = int((np.diff(np.concatenate([[0], m.astype(int), [0]])) == 1).sum())
        out.append((key, len(d), int(m.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~m].tobytes()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus()
    return rows, spark.createDataFrame([(*r, 1, "s", 2) for r in rows], "doc_id bigint, text string, key int, spans string, n_removed int").repartition(4)


@pytest.mark.parametrize("limit", [None, 1])
def test_against_brute_force(data, limit):
    rows, frame = data
    got = suffix.removed_bytes(frame, window=24, gram=6, max_regions=limit)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 24)


def test_production_window(spark):
    draw = random.Random(2)
    make = lambda n: "".join(draw.choices("abcdefgh ", k=n))
    passage = make(700)
    rows = [(i, make(800) + passage[draw.randrange(200) :] + make(300)) for i in range(6)] + [(7, make(2000)), (8, passage), (9, passage), (10, "word " * 5000), (11, "b" * 399), (12, "b" * 400)]
    got = suffix.removed_bytes(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 400)


def test_texts_keep_their_rows(data):
    rows, frame = data
    kept = suffix.remove_repeats(frame, window=24, gram=6)
    assert kept.columns == frame.columns and kept.count() == len(rows)
    by_size = {r.doc_id: r.text for r in kept.where("doc_id > 20 and doc_id < 24").collect()}
    assert all(by_size[i] == rows[i][1] for i in by_size if i % 4)
    assert suffix.removed_bytes(frame.limit(0)).count() == 0 and suffix.remove_repeats(frame.limit(0)).count() == 0
