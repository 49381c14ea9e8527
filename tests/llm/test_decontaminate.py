import random
import string

import numpy as np
import pyarrow as pa
import pytest

from caseloom.llm import decontaminate as d
from caseloom.llm.text import column_word_hashes, word_hashes


def overlap(equal, n):
    """12 of 16 aligned words, three quarters of a shorter item, or a run of gains 1 and losses 2 with 12 equal words."""
    needed = {5: 4, 6: 5, 7: 6, 8: 6, 9: 7, 10: 8, 11: 9, 12: 9, 13: 10, 14: 11}.get(n, 12)
    for start in range(len(equal)):
        if sum(equal[start : start + min(n, 16)]) >= needed:
            return True
        gain = count = 0
        for same in equal[start:]:
            gain, count = gain + (1 if same else -2), count + same
            if gain <= 0:
                break
            if count >= 12 and same:
                return True
    return False


def plain_words(text):
    edges = string.punctuation + "“”„‘’«»…–—¿¡·•"
    return [w.strip(edges).lower() for w in (text or "").split() if w.strip(edges)]


def brute(docs, items):
    """Every alignment of every item with every document that has an equal word."""
    found = {}
    for row, (_, text) in enumerate(docs):
        words, hit, places = plain_words(text), set(), {}
        for at, word in enumerate(words):
            places.setdefault(word, []).append(at)
        for i, item in items:
            theirs = plain_words(item)
            if len(theirs) < 5:
                continue
            for shift in {at - mine for mine, word in enumerate(theirs) for at in places.get(word, ())}:
                low, high = max(0, shift), min(len(words), shift + len(theirs))
                if overlap([words[x] == theirs[x - shift] for x in range(low, high)], len(theirs)):
                    hit.add(i)
                    break
        found[row] = sorted(hit)
    return found


def corpus():
    draw = random.Random(1)
    words = [f"w{i}" for i in range(5000)]
    items = [(i, " ".join(draw.choices(words, k=draw.choice([3, 5, 8, 12, 20, 40])))) for i in range(30)]
    items += [(30, items[0][1]), (31, None), (32, ""), (33, items[20][1]), (33, items[20][1])]
    docs = []
    for i in range(120):
        text = draw.choices(words, k=draw.randrange(5, 120))
        if i % 3 == 0:
            passage = (items[draw.randrange(30)][1]).split()
            for at in range(len(passage)):
                if draw.random() < 0.08:
                    passage[at] = draw.choice(words)
            at = draw.randrange(len(text))
            text[at:at] = [w.upper() + "," if draw.random() < 0.3 else w for w in passage]
        docs.append((i, " ".join(text)))
    docs += [(5, docs[5][1]), (5, docs[3][1]), (None, docs[3][1]), (None, None), (130, ""), (131, "word " * 3000), (132, " ".join(items[22][1].split()) + " x" * 20_000)]
    return docs, items


@pytest.fixture(scope="module")
def data(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id bigint, text string, item int, mark string").repartition(5)
    bench = spark.createDataFrame([(*r, "q") for r in items], "item_id bigint, text string, words string")
    return docs, items, frame, bench


def test_against_brute_force(data):
    docs, items, frame, bench = data
    want = brute(docs, items)
    got = sorted(((r.doc_id, r["items"]) for r in d.contamination(frame, bench).collect()), key=repr)
    exact = sorted(((docs[row][0], found) for row, found in want.items()), key=repr)
    missed = sum(a != b for a, b in zip(got, exact))
    assert len(got) == len(docs)
    # A seed can miss an overlap only if substitutions hit every window under every mask; none may be invented.
    assert missed <= 1, missed
    flat = {(k, i) for k, found in exact for i in found}
    assert {(k, i) for k, found in got for i in found} <= flat


def test_removal_keeps_clean_rows_whole(data):
    docs, items, frame, bench = data
    found = d.contamination(frame, bench)
    kept = d.remove_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert kept.count() == found.where("not contaminated").count() > 50


def test_empty_inputs(data):
    _, _, frame, bench = data
    assert d.contamination(frame.limit(0), bench).count() == 0
    assert d.contamination(frame, bench.limit(0)).where("contaminated").count() == 0


def changed(draw, passage, places):
    return " ".join(f"x{draw.random()}" if at in places else word for at, word in enumerate(passage))


def test_edited_passages_are_found_at_any_length(spark):
    """Figures written here, not taken from the operator: substitutions allowed by length, and what is always found."""
    draw = random.Random(3)
    allowed = {5: 1, 6: 1, 7: 1, 8: 2, 9: 2, 10: 2, 11: 2, 12: 2, 15: 2, 20: 2}
    items, docs, sure = [], [], set()

    def plant(passage, places, certain):
        name = len(items)
        items.append((name, " ".join(passage)))
        around = [f"z{draw.randrange(10**6)}" for _ in range(40)]
        docs.append((name, " ".join([*around[:20], changed(draw, passage, set(places)), *around[20:]])))
        if certain:
            sure.add(name)

    def words(n):
        return [f"w{draw.randrange(10**5)}" for _ in range(n)]

    for n, count in allowed.items():
        for _ in range(12):
            plant(words(n), draw.sample(range(n), count), True)
    for phase in range(4):
        plant(words(24), range(phase, 24, 4), True)
    for phase in range(5):
        plant(words(24), range(phase, 24, 5), True)
    first_random = len(items)
    for _ in range(60):
        plant(words(20), draw.sample(range(20), 4), False)
    clean = len(items)
    for n in (5, 8, 12, 20):  # half of the words are not an overlap
        plant(words(n), range(0, n, 2), False)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = d.contamination(frame, spark.createDataFrame(items, "item_id bigint, text string")).where("contaminated")
    got = {r.doc_id for r in found.collect()}
    assert sure <= got
    assert len([i for i in got if first_random <= i < clean]) >= 55
    assert not [i for i in got if i >= clean]


def test_words_of_a_column_equal_words_of_each_text():
    texts = ["", None, " a  B, b\x1cc\u2003d ", "--", "x " * 5000, "É “q”"]
    for limit in (1, 50, 1 << 20):
        got = {}
        for first, words, ends in column_word_hashes(pa.array(texts), limit):
            for row, side in enumerate(np.split(words, ends[:-1])):
                got[first + row] = side.tolist()
        assert got == {row: word_hashes(text).tolist() for row, text in enumerate(texts)}
    assert list(column_word_hashes(pa.array([], pa.string()))) == []


def test_long_text_is_scanned_in_parts(spark, monkeypatch):
    monkeypatch.setattr(d, "CHUNK", 7)
    passage = [f"p{i}" for i in range(30)]
    docs = [(at, " ".join([*[f"q{i}" for i in range(at)], *passage])) for at in range(10)]
    found = d.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(1, " ".join(passage))], "item_id bigint, text string"))
    assert {(r.doc_id, r.matched) for r in found.collect()} == {(at, 30) for at in range(10)}


def test_stretch():
    assert d.best_stretch(np.array([0, 1, 1, 0, 1, 1, 1, 0, 0, 1], bool)) == (5, 1, 7)
    assert d.best_stretch(np.array([0, 0], bool))[0] == 0
