"""Line differences of two versions of texts that survive inserted and removed lines."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def increasing_chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of pairs whose second numbers grow; the first numbers do already."""
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for i, (_, right) in enumerate(pairs):
        at = bisect_left(tops, right)
        before[i] = ends[at - 1] if at else -1
        tops[at : at + 1], ends[at : at + 1] = [right], [i]
    chain, at = [], ends[-1] if ends else -1
    while at >= 0:
        chain.append(pairs[at])
        at = before[at]
    return chain[::-1]


def _lengths(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``left`` and every beginning of ``right``."""
    row = np.zeros(len(right) + 1, np.int64)
    for line in left:
        longer = row.copy()
        longer[1:] = np.maximum(row[1:], row[:-1] + (right == line))
        row = np.maximum.accumulate(longer)
    return row


def common_subsequence(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A longest common subsequence as pairs of places, in memory proportional to the lines."""
    if not len(left) or not len(right):
        return []
    if len(left) == 1:
        at = np.flatnonzero(right == left[0])
        return [(0, int(at[0]))] if len(at) else []
    half = len(left) // 2
    cut = int(np.argmax(_lengths(left[:half], right) + _lengths(left[half:][::-1], right[::-1])[::-1]))
    later = common_subsequence(left[half:], right[cut:])
    return common_subsequence(left[:half], right[:cut]) + [(i + half, j + cut) for i, j in later]


def align(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, growing on both sides.

    Equal beginnings and ends pair up. In between the lines that occur once on both sides are anchors; their longest
    increasing chain stays, and every gap between two of its pairs is aligned alone. A gap without anchors takes a longest
    common subsequence.
    """
    found: list[tuple[int, int]] = []
    work = [(0, len(left), 0, len(right))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        ours, theirs = left[a:b].tolist(), right[c:d].tolist()
        once, twice = Counter(ours), Counter(theirs)
        place = {line: j for j, line in enumerate(theirs)}
        chain = increasing_chain([(i, place[line]) for i, line in enumerate(ours) if once[line] == 1 and twice.get(line) == 1])
        if not chain:
            found += [(a + i, c + j) for i, j in common_subsequence(left[a:b], right[c:d])]
            continue
        found += [(a + i, c + j) for i, j in chain]
        edges = [(-1, -1), *chain, (b - a, d - c)]
        work += [(a + i + 1, a + k, c + j + 1, c + m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(found)


def line_diff(old: DataFrame, new: DataFrame, key: str, text: str) -> DataFrame:
    """Lines of ``old`` and ``new`` texts with the same ``key``: same, removed or added.

    Lines end at a line feed; a null text has none, an empty one a single empty line. Keys are unique on each side and compare
    null-safe; a text without counterpart is all removed or all added. Only 64-bit digests of lines are aligned, one
    text in a task (40 bytes a line); the lines themselves stay with their rows and are joined to the result by number.
    Returns key, change ("same", "removed", "added"), old_line, new_line (1-based, null where there is none) and line.
    """
    def lines(df: DataFrame, side: int) -> DataFrame:
        return df.select(F.col(key).alias("__key"), F.posexplode(F.split(text, "\n", -1)).alias("__at", "line")).withColumn("__side", F.lit(side))

    kind = old.schema[key].dataType.simpleString()
    both = lines(old, 0).unionByName(lines(new, 1))
    digests = both.select("__key", "__side", "__at", F.xxhash64("line").alias("__hash"))

    def run(group: tuple, table: pa.Table) -> pa.Table:
        side, at, lines_ = (table.column(c).to_numpy() for c in ("__side", "__at", "__hash"))
        parts = []
        for s in (0, 1):
            mine = np.flatnonzero(side == s)
            parts.append(lines_[mine[np.argsort(at[mine])]])
        pairs = align(*parts)
        kept = [set(i for i, _ in pairs), set(j for _, j in pairs)]
        rows = [(0, i, "same", i + 1, j + 1) for i, j in pairs]
        rows += [(0, i, "removed", i + 1, None) for i in range(len(parts[0])) if i not in kept[0]]
        rows += [(1, j, "added", None, j + 1) for j in range(len(parts[1])) if j not in kept[1]]
        columns = [pa.array([group[0].as_py()] * len(rows), group[0].type)]
        columns += [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))]
        return pa.Table.from_arrays(columns, ["__of", "__from", "__place", "change", "old_line", "new_line"])

    found = digests.groupBy("__key").applyInArrow(run, f"__of {kind}, __from int, __place int, change string, old_line bigint, new_line bigint")
    same = F.col("__key").eqNullSafe(F.col("__of")) & (F.col("__side") == F.col("__from")) & (F.col("__at") == F.col("__place"))
    return found.join(both, same).select(F.col("__of").alias(key), "change", "old_line", "new_line", "line")


def diff_counts(diff: DataFrame, key: str) -> DataFrame:
    """Numbers of same, removed and added lines per text."""
    kinds = [F.count(F.when(F.col("change") == c, 1)).alias(f"n_{c}") for c in ("same", "removed", "added")]
    return diff.groupBy(key).agg(*kinds)
