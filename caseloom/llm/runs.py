"""Periodic runs of words: factors of power-of-two lengths are named, their progressions of successors propose the periods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words named together; a longer text is a group of its own.
GROUP_WORDS = 1 << 18

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"


def split_words(text: str | None) -> list[bytes]:
    """The maximal stretches without space, tab, line feed, vertical tab, form feed and carriage return, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _levels(symbols: np.ndarray, last: np.ndarray, longest: int, least_exponent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The dictionary of basic factors, one power of two after the other: (length, places, distance to the next occurrence).

    ``symbols`` differ between texts, so a factor never occurs in two of them. ``last`` is the end of a place's text. Only
    factors with a second occurrence are named: both halves of a factor that occurs again occur again.
    """
    size = 1
    places, keys = np.arange(len(symbols)), symbols
    name = np.empty(len(symbols), np.int64)
    # The next length serves periods above half of it.
    while len(places) and least_exponent * (size // 2 + 1) <= longest:
        order = np.argsort(keys, kind="stable")
        sorted_keys, sorted_places = keys[order], places[order]
        same = sorted_keys[1:] == sorted_keys[:-1]
        yield size, sorted_places[:-1][same], (sorted_places[1:] - sorted_places[:-1])[same]
        again = np.zeros(len(keys), bool)
        again[1:] |= same
        again[:-1] |= same
        group = np.cumsum(np.concatenate(([1], ~same)))[again]
        kept = sorted_places[again]
        name.fill(0)
        name[kept] = group
        places = np.sort(kept)
        places = places[places + 2 * size <= last[places]]
        places = places[name[places + size] > 0]
        keys = name[places] * (len(symbols) + 1) + name[places + size]
        size *= 2


def find_runs(symbols: np.ndarray, bounds: np.ndarray, least_length: int = 6, least_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs in texts joined end to end, by start, then period.

    Text t covers ``bounds[t]`` to ``bounds[t + 1]``. A run has the smallest period q, at least ``least_length`` symbols and
    ``least_exponent`` (four or more) periods, and no neighbour prolongs it. For a period q the factors of the power of two
    from q up to 2q - 1 are asked: where the next occurrence lies exactly q further on and once more q further on, a
    progression proposes q. Inside a run no nearer occurrence exists, else two periods met on more than their sum and q
    were not the smallest; and a run of four periods has room for three such occurrences. Neighbouring proposals join,
    the stretch grows by comparing symbols a period apart, repeated finds are dropped.
    """
    if least_exponent < 4:
        raise ValueError("runs of fewer than four periods are not searched")
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first, last = bounds[:-1][text], bounds[1:][text]
    longest = int(np.diff(bounds).max(initial=0))
    _, own = np.unique(symbols, return_inverse=True)
    own = text * (len(symbols) + 1) + own
    found = []
    step = np.zeros(len(symbols), np.int64)
    for size, places, distance in _levels(own, last, longest, least_exponent):
        near = (distance > size // 2) & (distance <= size)
        places, distance = places[near], distance[near]
        if not len(places):
            continue
        step.fill(0)
        step[places] = distance
        three = step[np.minimum(places + distance, len(step) - 1)] == distance
        places, distance = places[three], distance[three]
        if not len(places):
            continue
        order = np.argsort(places)
        places, distance = places[order], distance[order]
        joined = np.concatenate(([False], (places[1:] == places[:-1] + 1) & (distance[1:] == distance[:-1])))
        heads = np.flatnonzero(~joined)
        tails = np.concatenate((heads[1:], [len(places)])) - 1
        start, period = places[heads], distance[heads]
        stop = places[tails] + 2 * period + size
        low, high = first[start], last[start]
        grows = np.ones(len(start), bool)
        while grows.any():
            grows = start > low
            at = np.where(grows, start - 1, start)
            grows &= own[at] == own[at + period]
            start = start - grows
        grows = np.ones(len(stop), bool)
        while grows.any():
            grows = stop < high
            at = np.where(grows, stop, stop - 1)
            grows &= own[at] == own[at - period]
            stop = stop + grows
        long = stop - start >= np.maximum(least_length, least_exponent * period)
        found.append(np.stack((start[long], (stop - start)[long], period[long])))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    all_runs = np.unique(np.concatenate(found, axis=1)[[0, 2, 1]], axis=1)
    return all_runs[0], all_runs[2], all_runs[1]


def _analyse(group: list[tuple[object, list[bytes]]], least_length: int, least_exponent: int) -> Iterator[tuple]:
    """(key, n_words, runs, collapsed text) for texts given as words."""
    sizes = [len(words) for _, words in group]
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    every = pa.array([w for _, words in group for w in words], pa.large_binary())
    symbols = every.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = find_runs(symbols, bounds, least_length, least_exponent)
    edges = np.searchsorted(start, bounds)
    for t, (key, words) in enumerate(group):
        mine = slice(edges[t], edges[t + 1])
        begin = start[mine] - bounds[t]
        kept = words
        if len(begin):
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, begin + period[mine], 1)
            np.add.at(change, begin + length[mine], -1)
            kept = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        runs = [{"start": a, "length": b, "period": c} for a, b, c in zip(begin.tolist(), length[mine].tolist(), period[mine].tolist())]
        yield key, len(words), runs, b" ".join(kept).decode("utf-8", "surrogatepass")


def word_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least_length: int = 6, least_exponent: int = 4) -> DataFrame:
    """Every run of words of every whole text, and the text with each run reduced to its first period.

    Words are separated by ASCII white space and numbered from 0. A run is a stretch of consecutive words with smallest
    period q, at least ``least_length`` words and ``least_exponent`` periods, that no neighbouring word prolongs. A word is
    dropped if any run holds it after the run's first q words; the rest is joined by one space. Texts are read one Arrow
    batch at a time and need no shuffle; memory grows with the longest text (about 150 bytes a word).

    Null and empty texts have no words, no runs and an empty collapsed text. A row gives a row, also if it is repeated, if
    ids are null or occur twice; other columns are left out whatever their names, an empty table gives an empty result.
    Returns id, n_words long, runs (start, length, period; by start, then period), collapsed string.
    """
    kind = docs.schema[id].dataType
    chosen = docs.select(F.col(id).alias("key"), F.col(text).cast("string").alias("text"))
    names = ["key", "n_words", "runs", "collapsed"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            of_key = batch.schema.field("key").type

            def result(group):
                columns = list(zip(*_analyse(group, least_length, least_exponent)))
                kinds = [of_key, pa.int64(), run, pa.string()]
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

            group, held = [], 0
            for key, whole in zip(batch.column("key").to_pylist(), batch.column("text")):
                words = split_words(whole.as_py())
                if group and held + len(words) > GROUP_WORDS:
                    yield result(group)
                    group, held = [], 0
                group.append((key, words))
                held += len(words)
            if group:
                yield result(group)

    found = chosen.mapInArrow(search, f"key {kind.simpleString()}, n_words bigint, runs {RUN}, collapsed string")
    return found.withColumnRenamed("key", id)


def greatest_run(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the smaller start, then period. Null without runs."""
    before = lambda a, b: a["length"] * b["period"] - b["length"] * a["period"]
    order = lambda a, b: (
        F.when(before(a, b) > 0, -1).when(before(a, b) < 0, 1).when(a["start"] != b["start"], F.signum(a["start"] - b["start"]).cast("int"))
        .otherwise(F.signum(a["period"] - b["period"]).cast("int"))
    )
    return F.get(F.array_sort(runs, order), 0)


def tiled(words: Column, code: Column) -> Column:
    """Words from place ``code`` mod n on repeat with a period drawn from ``code``; n words stay n words."""
    n = F.size(words).cast("bigint")
    at = code % n
    period = F.lit(1) + F.floor((n - at) / (F.lit(3) + code % 8))
    whole = F.ceil((n - at) / period).cast("int")
    head, tile = F.slice(words, F.lit(1), at.cast("int")), F.slice(words, at.cast("int") + 1, period.cast("int"))
    return F.slice(F.concat(head, F.flatten(F.array_repeat(tile, whole))), F.lit(1), n.cast("int"))
