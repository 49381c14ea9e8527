"""Periodic runs of words against a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm import runs
from caseloom.llm.registry import ORACLES, QUERIES


def plain_runs(words, least=6, exponent=4):
    """All (start, length, period) by trying every period at every place."""
    found = {}
    n = len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_row(doc_id, text, plant=True):
    words = [w for w in runs.split_words(text)]
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = sorted(plain_runs(words), key=lambda r: (r[0], r[2]))
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    best = (None,) * 4
    for s, m, q in found:
        if best[0] is None or m * best[2] > best[1] * q:
            best = (s, m, q, 1000 * m // q)
    return (doc_id, len(found), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=5))
def test_all_runs_of_small_texts(texts):
    bounds = np.cumsum([0, *map(len, texts)])
    start, length, period = runs.find_runs(np.array([x for t in texts for x in t], np.int64), bounds)
    got = list(zip(start.tolist(), length.tolist(), period.tolist()))
    want = [(s + int(b), n, q) for t, b in zip(texts, bounds) for s, n, q in sorted(plain_runs(t), key=lambda r: (r[0], r[2]))]
    assert got == want


def test_nested_and_long_periods():
    draw = random.Random(3)
    base = [draw.randrange(50) for _ in range(37)]
    inner = [7, 8] * 6
    for period in (1, 2, 3, 4, 5, 7, 8, 9, 16, 17, 31, 32, 33):
        tile = (base + inner)[:period]
        for n in (4 * period - 1, 4 * period, 4 * period + 1, 9 * period + period // 2):
            words = [100, 101, *(tile[i % period] for i in range(n)), 102, *inner, 103]
            start, length, found = runs.find_runs(np.array(words), np.array([0, len(words)]))
            assert list(zip(start.tolist(), length.tolist(), found.tolist())) == sorted(plain_runs(words), key=lambda r: (r[0], r[2]))


def test_fewer_periods_are_refused():
    with pytest.raises(ValueError):
        runs.find_runs(np.zeros(3, np.int64), np.array([0, 3]), least_exponent=3)


TEXTS = [None, "", " \t\n", "a", "a a a a a a a", "x " * 5, "x " * 6, "a b " * 4, "a b c " * 4 + "a b", "ü ß  ü ß\nü\tß ü\x0bß ü ß", "one two " * 3000 + "end", " ".join(map(str, range(30))) * 5]


def test_rows(spark, monkeypatch):
    data = [(i, t, "x", 1) for i, t in enumerate(TEXTS * 8)] + [(None, "b b b b b b", "y", 2), (3, "a", "y", 2), (3, "a", "y", 2)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string, key string, runs int")
    want = sorted((repr(plain_row(i, t, plant=False)) for i, t, _, _ in data))
    for size in (10, 1 << 18):
        monkeypatch.setattr(runs, "GROUP_WORDS", size)
        found = runs.word_runs(docs).collect()
        got = []
        for r in found:
            best = (None,) * 4
            for x in r.runs:
                if best[0] is None or x.length * best[2] > best[1] * x.period:
                    best = (*x, 1000 * x.length // x.period)
            listed = "".join(f"{a},{b},{c}\n" for a, b, c in r.runs)
            got.append((r.doc_id, len(r.runs), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(r.collapsed.encode()).hexdigest()))
        assert sorted(map(repr, got)) == want
    assert runs.word_runs(docs.limit(0)).collect() == []


def test_query_against_brute_force(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()]
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 6000}
    assert len(got) == len(docs)
    assert sorted(r for r in got if r[0] in short) == sorted(plain_row(i, t) for i, t in short.items())
    planted = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 12)], "doc_id bigint, text string")
    planted.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(map(repr, got)) == sorted(repr(plain_row(i, t)) for i, t in enumerate(TEXTS * 12))


def test_against_sql(spark, folder):
    from oracle import compare, connect

    found = [p for p in compare(spark, connect(folder), QUERIES["op11_periodic_runs"], ORACLES["op11_periodic_runs"], folder) if not p.startswith("plan has")]
    assert found == []
