"""Helpers that run inside tasks: bounded memos, word hashes and exact pieces of texts for tokenizers."""

from __future__ import annotations

import re
import string
import sys
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Marks stripped from the edges of words before hashing.
EDGES = string.punctuation + "“”„‘’«»…–—¿¡·•"


class Memo(dict):
    """Values made on first use, in two generations of at most ``limit`` entries and ``size`` bytes each, so memory is bounded.

    Every key and value counts with its own bytes, those of the numbers in a tuple and its place in the table.

    When the young generation is full it becomes the old one; what is used again moves back, so frequent keys stay.
    Keys of more than ``LONGEST`` characters are not kept.
    """

    LONGEST = 1_000

    def __init__(self, make: Callable, limit: int = 300_000, size: int = 48 << 20):
        super().__init__()
        self.make, self.limit, self.size, self.held, self.old = make, limit, size, 0, {}

    def put(self, key, value, size=sys.getsizeof) -> None:
        """Keep a value in the young generation."""
        sized, kind = 100 + size(key) + size(value), type(key)
        if kind is tuple:
            sized += 32 * len(key)
        elif (kind is str or kind is bytes) and len(key) > self.LONGEST:
            return
        if type(value) is tuple:
            sized += 32 * len(value)
        if len(self) >= self.limit or self.held + sized > self.size:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        self.held += sized

    def put_all(self, made: dict) -> None:
        """Keep many strings and their bytes at once; those beyond a whole generation are left out."""
        sized = lambda: 100 * len(made) + sum(map(sys.getsizeof, made)) + sum(map(sys.getsizeof, made.values()))
        size = sized()
        while len(made) > self.limit or size > self.size:
            made = dict(islice(made.items(), min(self.limit, len(made) * self.size // (size + 1))))
            size = sized()
        if len(self) + len(made) > self.limit or self.held + size > self.size:
            self.old, self.held = dict(self), 0
            self.clear()
        self.update(made)
        self.held += size

    def forget(self) -> None:
        self.clear()
        self.old, self.held = {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value


def hash_word(word: str) -> int:
    """64-bit hash of a word in lower case without marks at its edges; 0 if nothing is left."""
    core = word.strip(EDGES).lower()
    return xxhash.xxh3_64_intdigest(core.encode("utf-8", "surrogatepass")) if core else 0


_WORDS = Memo(hash_word)


def release() -> None:
    """Give back what earlier tasks of this Python worker have kept: word hashes and unused Arrow memory."""
    _WORDS.forget()
    pa.default_memory_pool().release_unused()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text in order (words end at white space; words of marks only are left out)."""
    words = text.split() if text else []
    found = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    return found[found != 0]


def column_word_hashes(texts: pa.Array, limit: int = 4 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``word_hashes`` of many texts: the first row of a group, the word hashes of its rows in a row, and the rows' ends.

    Groups hold about ``limit`` bytes of text or a single longer one. Each distinct word of a group is hashed once.
    """
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    starts = np.flatnonzero(np.diff(group, prepend=-1)) if len(sizes) else np.zeros(0, np.int64)
    for first, end in zip(starts, [*starts[1:], len(sizes)]):
        lists = pc.utf8_split_whitespace(pc.fill_null(texts[first:end], ""))
        words = lists.flatten().dictionary_encode()
        hashes = np.fromiter(map(hash_word, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
        found = hashes[words.indices.to_numpy()] if len(words) else hashes
        kept = np.concatenate([[0], np.cumsum(found != 0)])
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        yield int(first), found[found != 0], kept[ends]


def mix(values: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values over all bits."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(33)
    v *= np.uint64(0xFF51AFD7ED558CCD)
    v ^= v >> np.uint64(33)
    v *= np.uint64(0xC4CEB9FE1A85EC53)
    v ^= v >> np.uint64(33)
    return v


def multipliers(seed: int, count: int) -> np.ndarray:
    """Odd 64-bit multipliers drawn from a seed, the same in every task."""
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``size`` words in a row. A text of fewer words (but at least one) is one shingle."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    factors = multipliers(size, size)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        total += words[i : len(words) - size + 1 + i] * factors[i]
    return np.unique(mix(total))


# A space that no visible character follows: there a piece must not begin.
_LOOSE = re.compile(r" (?=\s|\Z)")
_CUT = re.compile(r" (?=\S)")


def is_loose(text: str) -> bool:
    """True if a space of the text has no visible character after it."""
    return _LOOSE.search(text) is not None


def pieces(text: str) -> list[str]:
    """Cut a text before every space that a visible character follows; the spaces themselves are left out.

    A byte-level BPE pattern begins a match at every such space, whatever stands before it, so encoding
    piece by piece (with the space put back before all but the first) equals encoding the whole text.
    """
    return _CUT.split(text) if is_loose(text) else text.split(" ")
