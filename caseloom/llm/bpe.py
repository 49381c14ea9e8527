"""Byte-level BPE by dynamic programming over prefixes: every byte prefix has one valid last token.

A sequence of tokens is what the merges produce exactly if every token is stable by itself and every two
neighbours are (encoding their joined bytes gives the two back). So the encoding of a prefix ends in the one
token ``t`` whose bytes end the prefix and that is compatible with the last token of the prefix before it.
Storing only that token per prefix makes appends exact and lets an edit stop as soon as the table agrees again.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.text import Memo, pieces, release


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# Characters of texts whose pieces are encoded together.
GROUP_CHARS = 8_000_000

# More than any rank.
NEVER = 1 << 60

# Bytes at the end of a prefix that bound how far back its last token can begin.
TAIL = 3


class PrefixBpe:
    """Encoder for one table of ranks. ``pattern`` splits text into matches that are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.tokens = np.full(max(ranks.values()) + 1, None, object)
        self.tokens[list(self.bytes_of)] = list(self.bytes_of.values())
        # By the last TAIL bytes the length of the longest token that ends so; a token without such an entry is shorter.
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            if len(token) >= TAIL:
                self.reach[token[-TAIL:]] = max(len(token), self.reach.get(token[-TAIL:], 0))
        self.split = regex.compile(pattern).findall if pattern else lambda text: [text]
        self.stable = Memo(lambda rank: self.merge(self.bytes_of[rank]) == [rank], 200_000)
        self.traces = Memo(self._trace, 200_000)
        self.compatible = Memo(self._fits, 1_000_000)
        self.words = Memo(lambda match: self._packed(self.encode_match(match)), 300_000)
        # Keys are pieces without the space before them; the first piece of a text has none.
        self.chunks = Memo(lambda piece: self._encode_chunk(" " + piece), 300_000)
        self.first = Memo(self._encode_chunk, 20_000)
        self.table = PrefixTable(self)

    def merge(self, data: bytes) -> list[int]:
        """The merges themselves, lowest rank first: the definition that stability is checked against (short inputs only)."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get(parts[i] + parts[i + 1], NEVER), i))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.ranks[part] for part in parts]

    def _trace(self, rank: int) -> tuple[tuple[int, ...], tuple[bytes, ...], tuple[bytes, ...]]:
        """The ranks of the merges that make a stable token, in their order, and its first and last part before each of them."""
        data = self.bytes_of[rank]
        parts = [data[i : i + 1] for i in range(len(data))]
        merges, firsts, lasts = [], [parts[0]], [parts[-1]]
        while len(parts) > 1:
            found = [self.ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            merges.append(min(found))
            best = found.index(merges[-1])
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
            firsts.append(parts[0])
            lasts.append(parts[-1])
        return (*merges, NEVER), tuple(firsts), tuple(lasts)

    def _fits(self, pair: tuple[int, int]) -> bool:
        """Whether merging the joined bytes of two stable tokens gives the two back.

        Until a merge crosses their border each goes its own way, so the merges of both are gone through by rank, the left
        one's first where ranks are equal; one across the border comes after those of the left and before those of the right.
        """
        get = self.ranks.get
        left, _, ends = self.traces[pair[0]]
        right, begins, _ = self.traces[pair[1]]
        i = j = 0
        across = get(ends[0] + begins[0], NEVER)
        while True:
            if left[i] <= right[j]:
                if across < left[i]:
                    return False
                if left[i] == NEVER:
                    return True
                i += 1
            else:
                if across <= right[j]:
                    return False
                j += 1
            across = get(ends[i] + begins[j], NEVER)

    @staticmethod
    def _packed(ids: tuple[int, ...]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_match(self, data: bytes) -> tuple[int, ...]:
        """Ids of one match. A match that is itself a token is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        self.table.become(data)
        return tuple(self.table.ids())

    def _encode_chunk(self, chunk: str) -> bytes:
        return b"".join([self.words[match.encode("utf-8")] for match in self.split(chunk)])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers (null: none)."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text, worked off in groups of about ``GROUP_CHARS`` characters or a single longer one."""
        out, low, size = [], 0, 0
        for at, text in enumerate(texts):
            size += len(text) if text else 0
            if size >= GROUP_CHARS or at + 1 == len(texts):
                out += self._encode_group(texts[low : at + 1])
                low, size = at + 1, 0
        return out

    def _encode_group(self, texts: list[str | None]) -> list[bytes]:
        """Matches that are not known yet come in sorted order, so that each reuses the prefix of the one before."""
        parts = [pieces(text) if text else None for text in texts]
        # The ids of all pieces stay until the texts are done: a full memo may drop them before they are used.
        found: dict[str, bytes | None] = {}
        for part in parts:
            if part:
                found.update(dict.fromkeys(part[1:]))
        known, old, fresh = self.chunks, self.chunks.old, []
        for piece in found:
            ids = known.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    fresh.append((piece, [match.encode("utf-8") for match in self.split(" " + piece)]))
                else:
                    known.put(piece, ids)
            found[piece] = ids
        words = dict.fromkeys(sorted({match for _, matches in fresh for match in matches}))
        for match in words:
            words[match] = self.words[match]
        for piece, matches in fresh:
            found[piece] = b"".join(map(words.__getitem__, matches))
            known.put(piece, found[piece])
        return [self.first[part[0]] + b"".join(map(found.__getitem__, part[1:])) if part else b"" for part in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.tokens[np.frombuffer(ids, "<u4")].tolist())


class PrefixTable:
    """The last token of every prefix of a byte string, kept so that the string can grow or change."""

    def __init__(self, bpe: PrefixBpe, data: bytes = b""):
        self.bpe, self.data, self.last = bpe, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """Add bytes at the end; the entries of all earlier prefixes stay."""
        self.data += more
        self._extend(len(self.data))

    def _extend(self, stop: int) -> None:
        """Fill the entries up to ``stop``: the one token that ends the prefix and fits the entry before it."""
        ranks, stable, compatible, reach = self.bpe.ranks, self.bpe.stable, self.bpe.compatible, self.bpe.reach
        data, last = self.data, self.last
        for end in range(len(last) + 1, stop + 1):
            # Before TAIL bytes the slice is shorter than any key.
            for start in range(max(0, end - reach.get(data[end - TAIL : end], TAIL - 1)), end):
                token = ranks.get(data[start:end])
                if token is not None and stable[token] and (start == 0 or compatible[last[start - 1], token]):
                    last.append(token)
                    break
            else:
                raise ValueError(f"byte {data[end - 1]} is not in the vocabulary")

    def become(self, data: bytes) -> None:
        """Hold another string; the entries of the prefix it shares with the present one stay."""
        keep = 0
        for own, other in zip(self.data, data):
            if own != other:
                break
            keep += 1
        self.data = data
        del self.last[keep:]
        self._extend(len(data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes ``start`` to ``stop``; returns how many entries were made anew.

        An entry depends on the bytes and entries of the ``longest`` positions before it only. Once so many
        entries in a row equal the old ones, all later ones do.
        """
        old_tail, shift = self.last[stop:], start + len(new)
        self.data = self.data[:start] + new + self.data[stop:]
        del self.last[start:]
        made = agreeing = 0
        for end in range(start + 1, len(self.data) + 1):
            if agreeing >= self.bpe.longest:
                self.last.extend(old_tail[end - 1 - shift :])
                break
            self._extend(end)
            made += 1
            if end > shift:
                agreeing = agreeing + 1 if self.last[-1] == old_tail[end - 1 - shift] else 0
        return made

    def ids(self) -> list[int]:
        """Walk back from the end: the last token, then the last token of what is before it."""
        found, end = [], len(self.data)
        while end:
            found.append(self.last[end - 1])
            end -= len(self.bpe.bytes_of[found[-1]])
        return found[::-1]


_ENCODERS: dict[tuple[str, str | None], PrefixBpe] = {}


def encoder(path: str, pattern: str | None) -> PrefixBpe:
    """One encoder per Python worker, vocabulary and pattern."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = PrefixBpe(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, text: str = "text", key: str = "doc_id", keep_ids: bool = False) -> DataFrame:
    """Encode and decode the whole text of every row.

    ``vocabulary`` is a file of ranks that every executor has. Rows are independent of each other and nothing
    is shuffled; memos are bounded. Returns ``key``, n_tokens, ids_sha256 (of the ids as little-endian unsigned
    32-bit integers), decoded_sha256 (of the decoded bytes) and, with ``keep_ids``, ids.
    Null and empty texts have no tokens and the digest of no bytes. Repeated rows are repeated in the result,
    a null key stays null, other columns are ignored, an empty table gives an empty result.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        bpe = encoder(vocabulary, pattern)
        for batch in batches:
            rows = []
            for ids in bpe.encode_all(batch.column(1).to_pylist()):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest(), ids))
            n, digest, decoded, ids = zip(*rows) if rows else ((), (), (), ())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids
    return docs.select(key, F.col(text)).mapInArrow(encode, schema)
