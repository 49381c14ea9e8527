"""Licence notices in texts: exact pieces of short notices locate candidates, bounded-error matching verifies them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wordings of common notices, in lower case without marks.
NOTICES = {
    "gpl": ["gnu general public license", "under the terms of the gnu general public license as published by the free software foundation"],
    "lgpl": ["gnu lesser general public license", "gnu library general public license"],
    "agpl": ["gnu affero general public license"],
    "apache": ["apache license", "licensed under the apache license version 2 0", "you may not use this file except in compliance with the license"],
    "mit": ["mit license", "released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted", "bsd 2 clause license", "bsd 3 clause license"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"],
    "mpl": ["mozilla public license", "this source code form is subject to the terms of the mozilla public license"],
    "epl": ["eclipse public license"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0": ["cc0 1 0 universal", "creative commons zero"],
    "cc-by": ["licensed under cc by", "creative commons attribution license", "creative commons attribution 4 0 international"],
    "cc-by-sa": ["cc by sa", "licensed under cc by sa", "creative commons attribution sharealike"],
    "cc-by-nc": ["cc by nc", "licensed under cc by nc", "creative commons attribution noncommercial"],
    "cc-by-nd": ["cc by nd", "licensed under cc by nd", "creative commons attribution noderivatives"],
}

# A-Z become a-z; what is no digit, letter or byte beyond ASCII ends a word.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_GAPS = re.compile(rb"  +")

PLACE = "array<struct<label: string, notice: string, kind: string, start: bigint, stop: bigint, edits: int>>"


def plain_words(text: str | None) -> str:
    """The words of a text in lower case, joined by single spaces."""
    if not text:
        return ""
    return _GAPS.sub(b" ", text.encode("utf-8", "replace").translate(_PLAIN)).strip(b" ").decode("utf-8")


class Place(NamedTuple):
    label: str
    notice: str
    kind: str
    start: int
    stop: int
    edits: int


def split_pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice in ``edits`` + 1 pieces of nearly equal length with their offsets: that many edits leave one of them whole."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    """Finds phrases exactly and notices with at most ``share`` of their characters and ``most`` of them edited, on whole words.

    The pieces of all notices form one automaton that reads a text once. A piece found at some place allows a match only
    within ``edits`` characters of where it belongs; that window, cut to whole words, goes to the bounded-error matcher,
    which reports the best match inside, unless it holds the notice itself or too few of its trigrams. Matches of one notice do not overlap: a window begins after the one before.
    Results of windows are kept for repeated lines, up to ``KEPT`` of them.
    """

    KEPT = 20_000

    def __init__(self, phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]], share: float, most: int = 4):
        self.rules = [(label, words, "phrase", 0) for words, label in phrases.items()]
        self.rules += [(label, words, "notice", min(most, int(len(words) * share))) for label, many in notices.items() for words in many]
        self.found: dict[tuple[int, str], tuple[int, int, int] | None] = {}
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.matchers, self.shared = [], []
        for i, (_, words, _, edits) in enumerate(self.rules):
            if not words or plain_words(words) != words:
                raise ValueError(f"{words!r} is not in lower case with single spaces")
            for offset, piece in split_pieces(words, edits):
                seeds.setdefault(piece, []).append((offset, i))
            error = f"{{e<={edits}}}" if edits else ""
            # An edit changes at most three trigrams, so a match leaves this many of them in its window.
            trigrams = {words[j : j + 3] for j in range(len(words) - 2)}
            self.shared.append((trigrams, len(trigrams) - 3 * edits))
            self.matchers.append(regex.compile(rf"(?:{regex.escape(words, literal_spaces=True)}){error}(?![^ ])", regex.BESTMATCH))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if seeds:
            self.automaton.make_automaton()

    def _best(self, rule: int, window: str) -> tuple[int, int, int] | None:
        notice, edits = self.rules[rule][1], self.rules[rule][3]
        exact = f" {window} ".find(f" {notice} ")
        if exact >= 0:
            return exact, exact + len(notice), 0
        trigrams, least = self.shared[rule]
        if not edits or sum(t in window for t in trigrams) < least:
            return None
        key = (rule, window)
        if key not in self.found:
            if len(self.found) >= self.KEPT:
                self.found.clear()
            starts = [i for i in range(len(window) - len(notice) + edits + 1) if not i or window[i - 1] == " "]
            # Matched from each word in turn: a search never tries an insertion before its first character.
            matches = [m for m in (self.matchers[rule].match(window, i) for i in starts) if m]
            self.found[key] = min(((*m.span(), sum(m.fuzzy_counts)) for m in matches), key=lambda m: m[2], default=None)
        return self.found[key]

    def spans(self, words: str) -> list[tuple[int, int, int, int]]:
        """(rule, first character, end, edits) of all matches in words joined by single spaces, in order of their ends."""
        if not words or not self.rules:
            return []
        taken = [0] * len(self.rules)
        result = []
        for last, (size, uses) in self.automaton.iter(words):
            begin = last + 1 - size
            for offset, rule in uses:
                _, notice, kind, edits = self.rules[rule]
                if begin < taken[rule] and kind == "notice":
                    continue
                low = max(0, begin - offset - edits, taken[rule] if kind == "notice" else 0)
                high = min(len(words), begin - offset + len(notice) + edits)
                if low and words[low - 1] != " ":
                    low = words.find(" ", low, high) + 1
                    if not low:
                        continue
                if high < len(words) and words[high] != " ":
                    high = words.rfind(" ", low, high)
                if high - low < len(notice) - edits:
                    continue
                best = self._best(rule, words[low:high])
                if best and best[1] > best[0]:
                    result.append((rule, low + best[0], low + best[1], best[2]))
                    taken[rule] = low + best[1]
        return result

    def places(self, words: str) -> list[Place]:
        """Matches as places in words (numbered from 0, end exclusive). A notice gives way where one of another label overlaps with fewer edits."""
        spans = sorted(self.spans(words), key=lambda s: (s[1], s[2], s[0]))
        kept, ahead = [], 0
        reach = max((s[2] - s[1] for s in spans), default=0)
        for i, (rule, a, b, edits) in enumerate(spans):
            label, _, kind, _ = self.rules[rule]
            while spans[ahead][1] < a - reach:
                ahead += 1
            beaten = False
            j = ahead
            while kind == "notice" and edits and j < len(spans) and spans[j][1] < b and not beaten:
                other, c, d, fewer = spans[j]
                beaten = d > a and fewer < edits and self.rules[other][0] != label
                j += 1
            if not beaten:
                kept.append((rule, a, b, edits))
        out, at, count = [], 0, 0
        for rule, a, b, edits in kept:
            count += words.count(" ", at, a)
            at = a
            label, notice, kind, _ = self.rules[rule]
            out.append(Place(label, notice, kind, count, count + words.count(" ", a, b) + 1, edits))
        return out


def license_places(docs: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES, edit_share: float = 0.1,
                   most_edits: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Places of licence phrases and notices in every whole text.

    Texts are read as words of digits, letters and characters beyond ASCII, with A-Z in lower case. A phrase counts at every
    place where its words stand consecutively. A notice counts where whole words differ from it by at most ``edit_share`` of
    its characters, and no more than ``most_edits`` (inserted, deleted or substituted); its matches do not overlap each other, and one with edits gives way
    to an overlapping match of another label with fewer. No shuffle; memory grows with the longest text (about six times it).

    Null and empty texts have no words and no places. A row gives a row, also if it is repeated, if ids are null or occur
    twice; other columns are left out whatever their names, an empty table gives an empty result.
    Returns id, n_words long and places (label, notice, kind "phrase" or "notice", start, stop in words, edits) by start.
    """
    kind = docs.schema[id].dataType
    chosen = docs.select(F.col(id).alias("key"), F.col(text).cast("string").alias("text"))
    fixed, wanted = dict(phrases), {k: list(v) for k, v in notices.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(fixed, wanted, edit_share, most_edits)
        of_place = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("edits", pa.int32())]))
        for batch in batches:
            counts, places = [], []
            for whole in batch.column("text"):
                words = plain_words(whole.as_py())
                counts.append(words.count(" ") + 1 if words else 0)
                places.append([p._asdict() for p in scanner.places(words)])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(counts, pa.int64()), pa.array(places, of_place)], ["key", "n_words", "places"])

    found = chosen.mapInArrow(scan, f"key {kind.simpleString()}, n_words bigint, places {PLACE}")
    return found.withColumnRenamed("key", id)


def label_list(places: Column) -> Column:
    """Distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def license_summary(places: DataFrame) -> DataFrame:
    """A row per document of ``license_places``: counts and labels of phrases, all labels, and the share of the best place left as it should be.

    The score is 1 for an exact place, 1 - edits / characters of the notice for others, 0 without any.
    """
    base = F.filter("places", lambda p: p["kind"] == "phrase")
    starts = F.transform(base, lambda p: p["start"])
    likeness = F.transform("places", lambda p: F.lit(1.0) - p["edits"] / F.char_length(p["notice"]))
    return places.withColumns({
        "n_base": F.size(base).cast("bigint"), "first_word": F.array_min(starts), "last_word": F.array_max(starts),
        "base_labels": label_list(base), "labels": label_list(F.col("places")), "score": F.coalesce(F.array_max(likeness), F.lit(0.0)),
    })
