"""Quality and toxicity: held-out accuracy, edge cases, and the formulas against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from caseloom.llm import quality, toxicity


def held(key, folds, rest):
    return key is not None and zlib.crc32(str(key).encode()) % folds == rest


def corpus(n=400):
    draw = random.Random(6)
    syllables = ["ba", "ke", "lo", "mi", "tu", "ra", "se"]
    word = lambda: "".join(draw.choices(syllables, k=draw.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(draw.randrange(5, 200))]
        good, toxic = int(i % 5 != 0), int(i % 4 == 1)
        if toxic:
            for at in range(0, len(words), 8):
                words[at] = "zgru" + draw.choice(syllables)
        text = " ".join(words).capitalize() + "."
        docs.append((i, text if good else " ".join(w.upper() + "!!" for w in words)))
        if i % 10:
            labels.append((i, good, toxic))
    docs += [(None, "ba ke lo"), (n, None), (n + 1, ""), (n + 2, " \n "), (n + 3, "x" * 50_000), (n + 4, "ba " * 30_000), (7, docs[7][1]), (7, docs[5][1])]
    labels += [(None, 1, 1), (n, 1, 0), (3, None, None), (8, 7, 7), (9, 1, 0), (9, 0, 1)]
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    frame = spark.createDataFrame([(*d, 0.5, "s", 1) for d in docs], "doc_id bigint, text string, score double, source string, predicted int").repartition(4)
    return docs, labels, frame, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize(("score", "label", "folds", "rest"), [(quality.quality_scores, 1, 4, 2), (toxicity.toxicity_scores, 2, 3, 1)])
def test_scores(data, score, label, folds, rest):
    docs, labels, frame, known = data
    got = score(frame, known).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((d[0] for d in docs), key=repr)
    truth = {row[0]: row[label] for row in labels[:-6]}
    assert all(r.held_out == held(r.doc_id, folds, rest) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in truth and r.doc_id not in (7, 9)]
    assert len(unseen) > 60 and sum(r.predicted == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


@pytest.mark.parametrize("score", [quality.quality_scores, toxicity.toxicity_scores])
def test_without_rows_or_labels(data, score):
    _, _, frame, known = data
    assert score(frame.limit(0), known).count() == 0
    assert {r.predicted for r in score(frame, known.limit(0)).collect()} == {0}


def test_labels_of_the_held_out_fold_change_nothing(data, spark):
    docs, labels, frame, known = data
    flipped = spark.createDataFrame([(k, 1 - q if held(k, 4, 2) and q in (0, 1) else q, t) for k, q, t in labels], known.schema)
    one, two = (sorted((round(r.score, 9), repr(r.doc_id)) for r in quality.quality_scores(frame, x).collect()) for x in (known, flipped))
    assert one == two


def test_discriminant_equals_the_densities():
    draw = np.random.default_rng(2)
    x = {c: draw.normal(c, 1 + c, (200, 3)) for c in (0, 1)}
    model = quality.Discriminant({c: (200.0, x[c].sum(axis=0), x[c].T @ x[c]) for c in x}, pooling=0.0, ridge=0.0)
    point = draw.normal(0, 2, (20, 3))
    logs = []
    for c in (0, 1):
        mean, cov = x[c].mean(axis=0), np.cov(x[c].T, bias=True) + 1e-6 * np.eye(3)
        d = point - mean
        logs.append(-0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + math.log(np.linalg.det(cov))))
    assert np.allclose(model.score(point), 1 / (1 + np.exp(logs[0] - logs[1])), atol=1e-6)


@pytest.mark.parametrize("across", [False, True])
def test_spelling_models_equal_plain_kneser_ney(spark, across, monkeypatch):
    docs, labels = corpus(60)
    classes = {k: t for k, _, t in labels[:-6]}
    texts = [(t, classes[k]) for k, t in docs if k in classes and t]
    models = toxicity.train(spark.createDataFrame(texts, "text string, class int").repartition(3), across=across)
    raw = [Counter(), Counter()]
    for text, c in texts:
        for w in toxicity.units_of(text, across):
            w = f" {w} "
            for i in range(1, len(w)):
                raw[c][w[max(0, i - toxicity.ORDER + 1) : i + 1]] += 1
    counts = [Counter({g: n for g, n in raw[c].items()}) for c in (0, 1)]
    for c in (0, 1):
        after = defaultdict(set)
        for g in {g[i:] for g in raw[c] for i in range(len(g))}:
            if len(g) > 1:
                after[g[1:]].add(g[0])
        for g, before in after.items():
            counts[c][g] += len(before)
    base = Counter({g: 1 for g in range(1 << toxicity.CHAR_BITS)})
    for c in (0, 1):
        for g, n in counts[c].items():
            if len(g) == 1:
                base[ord(g)] += n
    total = sum(base.values())
    nexts = [defaultdict(list) for _ in (0, 1)]
    for c in (0, 1):
        for g, n in counts[c].items():
            if len(g) > 1:
                nexts[c][g[:-1]].append(n)

    def p(c, history, w):
        if not history:
            return base[ord(w)] / total
        lower, seen = p(c, history[1:], w), nexts[c].get(history)
        return lower if not seen else (max(counts[c][history + w] - 0.75, 0) + 0.75 * len(seen) * lower) / sum(seen)

    def plain(text):
        whole = f" {text} "
        return [math.log(p(1, h, w) / p(0, h, w)) for h, w in ((whole[max(0, i - toxicity.ORDER + 1) : i], whole[i]) for i in range(1, len(whole)))]

    if across:
        # The scores' inputs: mean ratio and highest stretches, over the texts themselves and small pieces and chunks of them.
        monkeypatch.setattr(toxicity, "PIECE_CHARS", 500)
        monkeypatch.setattr(toxicity, "CHUNK_CHARS", 2000)
        monkeypatch.setattr(toxicity, "BLOCK_ROWS", 100)
        some = [t for t, _ in texts[:12]] + [None, "", "q", "bake zgrulo"]
        docs = spark.createDataFrame(list(enumerate(some)), "doc_id bigint, text string")
        for row in toxicity.log_ratios(docs, models).collect():
            units = toxicity.units_of(some[row.doc_id], True)
            r = plain(units[0]) if units and units[0] else []
            assert row.n_chars == len(r) and abs(row.log_ratio - sum(r) / max(1, len(r))) < 1e-6
            for j, size in enumerate(toxicity.WINDOWS):
                stretches = [sum(r[i : i + size]) / size for i in range(max(1, len(r) - size + 1))] if r else [0.0]
                assert abs(row.windows[2 * j] - max(stretches)) < 1e-6
                at = lambda i: stretches[min(i, len(stretches) - 1)]  # noqa: E731, B023
                spans = sorted((max(at(i) for i in range(low, min(low + toxicity.SPAN, len(r)))) for low in range(0, len(r), toxicity.SPAN)), reverse=True)[: toxicity.TOP]
                assert abs(row.windows[2 * j + 1] - (sum(spans) / len(spans) if spans else 0.0)) < 1e-6
    for word in ("bake", "zgrulo", "q", "lomitu", "zgru"):
        whole = f" {word} "
        want = sum(math.log(p(1, h, w) / p(0, h, w)) for h, w in ((whole[max(0, i - toxicity.ORDER + 1) : i], whole[i]) for i in range(1, len(whole))))
        assert abs(models.ratios([word])[0] - want) < 1e-3


def test_rejected_rows_are_judged_by_their_own_text(data):
    docs, _, frame, known = data
    kept = toxicity.remove_toxic(frame, known)
    assert kept.columns == frame.columns
    predicted = toxicity.toxicity_scores(frame, known)
    assert kept.count() == predicted.where("predicted = 0").count()
    assert {r.text for r in kept.where("doc_id is null or doc_id >= 400").collect()} == {t for k, t in docs if k is None or k >= 400}


def test_grams_are_exact_for_every_alphabet_and_cross_words(spark):
    ordinary, toxic = ["ka lo", "mi tu"] * 50, ["ka tu"] * 50
    models = toxicity.train(spark.createDataFrame([(t, 0) for t in ordinary] + [(t, 1) for t in toxic], "text string, class int"), across=True)
    expression, other = (models.ratios([text])[0] for text in ("ka tu", "ka lo"))
    assert expression > 1 > -1 > other
    # These characters agree in the bits that a folded table would keep.
    grams = toxicity.Grams(["aѡ", "\U00010461b", "aa"])
    assert len({(h, l) for h, l in zip(grams.hi, grams.lo)}) == grams.starts[-1]
    spelled = {"".join(chr(c) for c in (hi >> 21 & 0x1FFFFF, hi & 0x1FFFFF, lo >> 42, lo >> 21 & 0x1FFFFF, lo & 0x1FFFFF) if c) for hi, lo in zip((grams.hi & (1 << 42) - 1).tolist(), grams.lo.tolist())}
    assert spelled == {f" {w} "[i:j] for w in ("aѡ", "\U00010461b", "aa") for i in range(len(w) + 2) for j in range(i + 1, min(len(w) + 2, i + 5) + 1)}


def test_grams_are_found_in_sorted_lists():
    draw = np.random.default_rng(1)
    hi, lo = draw.integers(0, 5, 200), draw.integers(0, 50, 200)
    pairs = sorted(set(zip(hi.tolist(), lo.tolist())))
    known, asked = pairs[::2], pairs + [(9, 0), (0, 99), (9, 99)]
    got = toxicity.find_grams(*np.array(asked).T, *np.array(known).T)
    assert got.tolist() == [known.index(x) if x in known else -1 for x in asked]
    assert toxicity.find_grams(hi, lo, hi[:0], lo[:0]).tolist() == [-1] * 200


def test_grams_of_parts_are_merged_and_searched_by_one_index():
    draw = np.random.default_rng(2)
    parts = [(draw.integers(0, 5, n), draw.integers(0, 50, n)) for n in (0, 30, 200)]
    hi, lo = toxicity.distinct_grams(parts)
    known = sorted({pair for part in parts for pair in zip(*(x.tolist() for x in part))})
    assert list(zip(hi.tolist(), lo.tolist())) == known
    index = toxicity.GramIndex(hi, lo)
    for part in parts:
        assert index.find(*part).tolist() == [known.index(pair) for pair in zip(*(x.tolist() for x in part))]
    assert [len(x) for x in toxicity.distinct_grams(parts[:1])] == [0, 0]


def test_few_toxic_labels_still_give_scores(spark):
    """The calibrating fifth has no toxic row here: scores come from all labelled rows."""
    frame = spark.createDataFrame([(i, "zgru zgro " * 9 if i % 6 == 1 else "ba ke lo mi " * 9) for i in range(60)], "doc_id bigint, text string")
    fifth = {r.doc_id for r in frame.selectExpr("doc_id", "pmod(xxhash64(doc_id), 5L) = 0 as spare").where("spare").collect()}
    known = spark.createDataFrame([(i, int(i % 6 == 1)) for i in range(60) if i % 6 != 1 or i not in fifth], "doc_id bigint, toxic int")
    got = toxicity.toxicity_scores(frame, known).collect()
    assert all(r.predicted == int(r.doc_id % 6 == 1) for r in got)


def test_grams_are_numbered_alike_by_table_and_by_hash():
    draw = np.random.default_rng(5)
    keys = draw.integers(0, 900, 3_000)
    for size in (900, 1 << 40):  # a table of all possible keys, or too many for that
        number, one = toxicity.number_of(keys, size)
        assert len(one) == len(np.unique(keys)) and (keys[one][number] == keys).all()
    units = ["".join(draw.choice(list("abc é\u4e2d"), n)) for n in draw.integers(0, 9, 60)] + ["".join(map(chr, range(0x4E00, 0x5200)))]
    grams = toxicity.Grams(units)
    spell = [tuple((g >> (toxicity.CODE_BITS * i)) & ((1 << toxicity.CODE_BITS) - 1) for i in range(toxicity.ORDER)[::-1] if i < n) for g, n in (
        (((h & ((1 << toxicity.HIGH_BITS) - 1)) << toxicity.LOW_BITS) | low, h >> toxicity.HIGH_BITS) for h, low in zip(grams.hi.tolist(), grams.lo.tolist()))]
    padded = [[ord(c) for c in f" {u} "] for u in units]
    assert [spell[e] for e in grams.ends] == [tuple(u[max(0, i - toxicity.ORDER + 1) : i + 1]) for u in padded for i in range(1, len(u))]
    assert len(set(spell)) == len(spell)
    longer = [i for i, s in enumerate(spell) if len(s) > 1]
    assert all(spell[grams.context[i]] == spell[i][:-1] and spell[grams.suffix[i]] == spell[i][1:] for i in longer)
