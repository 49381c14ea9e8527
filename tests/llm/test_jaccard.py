import random

import numpy as np
import pytest

from caseloom.llm import graph, jaccard
from caseloom.llm.text import shingles, word_hashes


def corpus():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for group in range(25):
        base = draw.choices(words, k=draw.randrange(20, 200))
        for copy in range(draw.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 5])):
                text[draw.randrange(len(text))] = draw.choice(words)
            texts.append(" ".join(text))
    texts += [None, "", " ", "...", "one two", "One, two!", "one two three", "a b c d e", "very " * 5000, "very " * 6000, texts[0], texts[0]]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[5]), (None, "only here without key five"), (None, "only here without key five")]


def brute(rows):
    sets = [set(shingles(word_hashes(t)).tolist()) for _, t in rows]
    n, near = len(rows), [set() for _ in rows]
    for i in range(n):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                near[i].add(j)
                near[j].add(i)
    name, out = list(range(n)), []
    for i in range(n):
        stack = [i]
        while stack:
            x = stack.pop()
            for y in near[x]:
                if name[y] > name[i]:
                    name[y] = name[i]
                    stack.append(y)
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(n) if name[j] == name[i] and rows[j][0] is not None]
        equal = sum(1 for j in range(n) if sets[j] == sets[i]) if sets[i] else 1
        out.append((key, min(keys) if keys else None, len(near[i]), equal))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data(spark):
    rows = corpus()
    return rows, spark.createDataFrame([(*r, 1, b"x") for r in rows], "doc_id bigint, text string, key int, node binary").repartition(4)


@pytest.mark.parametrize("members", [4096, 3])
def test_against_brute_force(data, monkeypatch, members):
    rows, frame = data
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", members)
    got = jaccard.near_duplicates(frame).select("doc_id", "class_id", "n_links", "n_equal")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_keep_one(data):
    rows, frame = data
    kept = jaccard.keep_one(frame)
    want = brute(rows)
    assert kept.columns == frame.columns
    got = kept.collect()
    wordless = [r for r in rows if not len(word_hashes(r[1]))]
    # Classes with a key; the class without any key; rows without words.
    names = {c for k, c, _, _ in want if c is not None} - {r[0] for r in wordless}
    assert len(got) == len(names) + 1 + len(wordless)
    assert names <= {r.doc_id for r in got}


def test_empty(data):
    assert jaccard.near_duplicates(data[1].limit(0)).count() == 0
    assert jaccard.keep_one(data[1].limit(0)).count() == 0


def test_prefix_is_shortened_until_the_target():
    assert jaccard.prefix_depth(0.8, 0.999) == 3 and jaccard.prefix_depth(0.95, 0.999) > 3
    assert jaccard.recall(3, 0.8) >= 0.999


def test_minima_estimate_similarity():
    draw = np.random.default_rng(1)
    found = draw.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = jaccard.signature(np.sort(found[:2700])), jaccard.signature(np.sort(found[300:]))
    assert abs((a == b).mean() - 0.8) < 0.17


def test_components(spark):
    draw = random.Random(2)
    links = [(f"{i:03}", f"{i + 1:03}") for i in range(0, 60) if i != 30] + [(f"{draw.randrange(70, 99):03}", "099") for _ in range(40)] + [("200", "200")]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert all(got[f"{i:03}"] == ("000" if i <= 30 else "031") for i in range(61))
    hub = {a for a, b in links if b == "099"} | {"099"}
    assert {got[x] for x in hub} == {min(hub)} and "200" not in got
    assert graph.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_keep_one_leaves_repeated_rows_without_words(spark):
    from caseloom.llm.jaccard import keep_one

    text = "one two three four five six seven"
    rows = [(None, None, "a"), (None, None, "b"), (None, "", "c"), (None, "", "d"), (4, " ! ", "e"), (4, " ! ", "f"), (1, text, "g"), (1, text, "h"), (2, text, "i"), (3, "other", "j")]
    kept = keep_one(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    left = sorted(r.source for r in kept.collect())
    assert [x for x in left if x not in "gh"] == ["a", "b", "c", "d", "e", "f", "j"] and len(left) == 8
