"""Licence scans: phrases against SQL, notices against a plain edit distance over all spans of words."""

import random

import pytest
from oracle import connect

from caseloom.llm import licenses
from caseloom.llm.licenses import NOTICES, PHRASES, Scanner, plain_words
from caseloom.llm.registry import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def least_edits(words, notice, most):
    """Fewest edits between the notice and any span of whole words, None beyond ``most``."""
    parts = words.split(" ") if words else []
    best = None
    for i in range(len(parts)):
        for j in range(i + 1, len(parts) + 1):
            span = " ".join(parts[i:j])
            if len(span) > len(notice) + most:
                break
            if len(span) >= len(notice) - most:
                d = distance(notice, span)
                if d <= most and (best is None or d < best):
                    best = d
    return best


def garbled(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = draw.randrange(len(letters) + 1)
        kind = draw.randrange(3)
        if kind == 0:
            letters.insert(at, draw.choice("abcxyz é"))
        elif letters:
            at = min(at, len(letters) - 1)
            if kind == 1:
                del letters[at]
            else:
                letters[at] = draw.choice("abcxyz é")
    return "".join(letters)


def test_every_notice_within_the_bound_is_found():
    draw = random.Random(4)
    scanner = Scanner({}, NOTICES, 0.1)
    rules = [(label, words, edits) for label, words, _, edits in scanner.rules]
    filler = ["der", "commit", "licenses", "public", "general", "mit", "cc", "under", "the", "söme", "license", "by"]
    hits = 0
    for trial in range(400):
        label, notice, most = draw.choice(rules)
        parts = [draw.choice(filler) for _ in range(draw.randrange(4))] + [garbled(draw, notice, draw.randrange(most + 3))] + [draw.choice(filler) for _ in range(draw.randrange(4))]
        words = plain_words(" ".join(parts))
        got = {}
        for rule, a, b, edits in scanner.spans(words):
            # What is reported is a span of whole words at the stated distance.
            assert (a == 0 or words[a - 1] == " ") and (b == len(words) or words[b] == " ")
            assert distance(rules[rule][1], words[a:b]) == edits <= rules[rule][2]
            got[rule] = min(edits, got.get(rule, 99))
        # The notices of three characters a piece and less are covered by the others' code; all are compared where the text is short.
        chosen = [(i, r) for i, r in enumerate(rules) if r[1] == notice or len(r[1]) < 30]
        for i, (_, other, bound) in chosen:
            want = least_edits(words, other, bound)
            assert (want is None) == (i not in got), (words, other, want, got.get(i))
            if want is not None:
                hits += 1
    assert hits > 150


def test_pieces_cover_the_notice():
    for k in range(6):
        pieces = licenses.split_pieces("gnu general public license", k)
        assert len(pieces) == k + 1 and "".join(p for _, p in pieces) == "gnu general public license"


def labels_of(text):
    places = Scanner(PHRASES, NOTICES, 0.1).places(plain_words(text))
    return {p.label for p in places}, places


def test_labels():
    assert labels_of("Licensed under CC BY-NC 4.0.")[0] == {"cc-by", "cc-by-nc"}
    assert labels_of("Licenced under the Apche License, Version 2.0")[0] == {"apache"}
    assert labels_of("GNU Lesser General Public License")[0] == {"lgpl"}
    assert labels_of("THE MIT LICENCE")[0] == {"mit"}
    assert labels_of("We commit licensees, mit Lizenz, apache, public license")[0] == set()
    found, places = labels_of("x mit license y Released-under the MIT License")
    assert found == {"mit"}
    assert [(p.start, p.stop, p.edits) for p in places if p.kind == "phrase"] == [(1, 3, 0), (7, 9, 0)]
    assert (4, 9, 0) in [(p.start, p.stop, p.edits) for p in places if p.notice == "released under the mit license"]


def test_unclean_notices_are_refused():
    with pytest.raises(ValueError):
        Scanner({}, {"x": ["Not Lower"]}, 0.1)


TEXTS = [None, "", " ", "...", "MIT License", "mit-license MIT license mit  license", "GNU\nGENERAL public-LICENSE, cc by", "ccby cc.by cc'by éccc by",
         "mit license " * 5000, "x" * 100_000, "word " * 30_000 + "Apache Licence", "Released under teh MIT Lisense.", "日本 mit license 日本", "mit licenseé", "emailmit license"]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "mit license", 2, "y"), (4, "MIT License", 1, "x")], "doc_id bigint, text string, n_words int, places string")
    got = {r.doc_id: r for r in licenses.license_summary(licenses.license_places(docs)).collect()}
    assert licenses.license_places(docs).count() == len(TEXTS) + 2
    assert got[0].n_words == got[1].n_words == got[3].n_words == 0 and got[0].score == 0.0 and got[0].first_word is None and got[0].labels == ""
    assert (got[5].n_base, got[5].first_word, got[5].last_word, got[5].base_labels) == (3, 0, 4, "mit")
    assert (got[6].base_labels, got[6].labels, got[6].score) == ("cc-by,gpl", "cc-by,gpl", 1.0)
    assert (got[7].n_base, got[7].first_word) == (2, 1)
    assert (got[8].n_base, got[8].last_word, got[8].n_words) == (5000, 9998, 10000)
    assert (got[10].n_base, got[10].labels) == (0, "apache") and 0.9 < got[10].score < 1
    assert (got[11].base_labels, got[11].labels) == ("", "mit")
    assert (got[12].n_base, got[13].n_base, got[14].n_base) == (1, 0, 0)
    assert got[None].labels == "mit"
    assert licenses.license_places(docs.limit(0)).collect() == []


def test_phrases_against_sql(spark, folder):
    for where in (folder, folder.replace("sf0.001", "sf0.01")):
        con = connect(where)
        want = con.execute(
            r"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
            p AS (SELECT unnest(['gnu general public license', 'apache license', 'cc by', 'mit license']) AS phrase, unnest(['gpl', 'apache', 'cc-by', 'mit']) AS label),
            h AS (SELECT doc_id, label, i FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM w), p
              WHERE w[i + 1] = split_part(phrase, ' ', 1) AND array_to_string(w[i + 1 : i + len(string_split(phrase, ' '))], ' ') = phrase)
            SELECT w.doc_id, any_value(len(w)), count(i), min(i), max(i), coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') FROM w LEFT JOIN h USING (doc_id) GROUP BY w.doc_id"""
        ).fetchall()
        got = QUERIES["op13_license_scan"](spark, where).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_query_against_plain_labels(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    scanner = Scanner(PHRASES, NOTICES, 0.1)
    hits = 0
    for r in QUERIES["op13_license_scan"](spark, folder).collect():
        words = plain_words(docs[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score > 0) == bool(r.labels)
        hits += bool(r.labels)
        if len(words) < 1500:
            want = {label for label, notice, kind, most in scanner.rules if most <= 3 and least_edits(words, notice, most) is not None}
            assert want <= set(filter(None, r.labels.split(","))) | {"cc-by-nd", "cc-by-sa", "cc-by-nc"}
    assert hits
