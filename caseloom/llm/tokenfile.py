"""Token ids in seekable files: independent zstandard frames, then a document index and a seek table.

File layout, readable by any zstandard decoder:

* frames of consecutive ids (little-endian unsigned 32-bit), cut after a document once a frame holds
  ``frame_bytes``; longer documents continue in further frames;
* one skippable frame with the document index (Arrow: key, number of ids);
* one skippable frame with the seek table of the public seekable format: for each frame its compressed size,
  its plain size and the low 32 bits of the xxh64 of its plain bytes; then the number of frames, a descriptor
  byte and the magic number.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.text import Memo, is_loose, pieces
from caseloom.session import materialize, open_store, scratch_path

# Fixed values of the seekable format.
SKIPPABLE_INDEX, SKIPPABLE_TABLE, TABLE_MAGIC, WITH_CHECKSUMS = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1, 0x80

# Characters of texts whose pieces are encoded together.
GROUP_CHARS = 8_000_000

# Marks that are cut off behind a letter, and the letters after which they are: those of the oldest blocks, known to every library.
MARKS = ".,;:!?"
LETTERS = frozenset(c for c in map(chr, range(0x250)) if c.isalpha())

# Tasks that read files at most.
MAX_READERS = 10_000


class TokenWriter:
    """Writes one file to an open binary stream."""

    def __init__(self, sink, key_type: pa.DataType, frame_bytes: int = 1 << 16, level: int = 1):
        self.sink, self.key_type, self.frame_bytes = sink, key_type, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.waiting, self.size, self.table, self.keys, self.counts, self.written = [], 0, [], [], [], 0

    def add(self, key, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit integers."""
        self.keys.append(key)
        self.counts.append(len(ids) // 4)
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_bytes:
            self._flush()

    def _flush(self, most: int = 1 << 23) -> None:
        plain = b"".join(self.waiting)
        for at in range(0, len(plain), most):
            part = plain[at : at + most]
            packed = self.pack.compress(part)
            self.sink.write(packed)
            self.written += len(packed)
            self.table.append((len(packed), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.waiting, self.size = [], 0

    def close(self) -> None:
        self._flush()
        stream = pa.BufferOutputStream()
        index = pa.table({"key": pa.array(self.keys, self.key_type), "n": pa.array(self.counts, pa.int64())})
        with pa.ipc.new_stream(stream, index.schema) as out:
            out.write_table(index)
        packed = zstandard.ZstdCompressor(level=3).compress(stream.getvalue().to_pybytes())
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed) + 4) + packed + struct.pack("<I", len(packed)))
        rows = b"".join(struct.pack("<III", *row) for row in self.table) + struct.pack("<IBI", len(self.table), WITH_CHECKSUMS, TABLE_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_TABLE, len(rows)) + rows)


class TokenReader:
    """Reads ids of chosen documents from a seekable binary stream; only the frames they lie in are decompressed."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        count, mark, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != TABLE_MAGIC or mark != WITH_CHECKSUMS:
            raise ValueError("no seek table")
        start = end - 9 - 12 * count
        self.table = list(struct.iter_unpack("<III", self._at(start, 12 * count)))
        self.packed_at = [0, *accumulate(row[0] for row in self.table)]
        self.plain_at = np.array([0, *accumulate(row[1] for row in self.table)], np.int64)
        size = struct.unpack("<I", self._at(start - 12, 4))[0]
        with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self._at(start - 12 - size, size))) as index:
            index = index.read_all()
        self.keys, self.counts = index.column("key"), index.column("n").to_numpy()
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.unpack, self.held = zstandard.ZstdDecompressor(), (-1, b"")
        self.frames_read = 0

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            packed, plain, check = self.table[k]
            data = self.unpack.decompress(self._at(self.packed_at[k], packed), max_output_size=plain)
            if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {k} fails its checksum")
            self.held, self.frames_read = (k, data), self.frames_read + 1
        return self.held[1]

    def document(self, i: int) -> bytes:
        """Ids of the ``i``-th document of the file."""
        low, high = 4 * int(self.starts[i]), 4 * int(self.starts[i + 1])
        found, k = [], int(np.searchsorted(self.plain_at, low, "right")) - 1
        while low < high:
            base, data = int(self.plain_at[k]), self.frame(k)
            found.append(data[low - base : high - base])
            low, k = base + len(data), k + 1
        return b"".join(found)


def words_of_lines(piece: str) -> list[tuple[str, str]]:
    """Words and the marks behind them of a piece that holds line feeds, all but the first with the line feed before them.

    Between a letter or mark and a letter a line feed is a match of the pattern by itself, and so is a mark after a letter.
    Empty if the piece is not made of these alone.
    """
    words = []
    for line in piece.split("\n"):
        mark = line[-1:] if line[-1:] in MARKS else ""
        word = line[: len(line) - len(mark)]
        if word[-1:] not in LETTERS or words and word[0] not in LETTERS:
            return []
        words.append(("\n" * bool(words) + word, mark))
    return words


class PieceEncoder:
    """Ids of whole texts with the tokenizers library, each distinct piece encoded once while the memo holds it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        # Tokens are spelled with one letter per byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.sizes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        # Keys are pieces without the space before them; the first piece of a text has none.
        self.memo = Memo(lambda piece: self._ids(" " + piece).tobytes(), 800_000, 96 << 20)
        self.first = Memo(lambda piece: self._ids(piece).tobytes(), 20_000)
        self.marks = {mark: self._ids(mark).tobytes() for mark in ["", *MARKS]}

    def _ids(self, text: str) -> np.ndarray:
        # Unlike ``encode`` this does not track where tokens lie in the text.
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, fresh: list[str], before: str = " ", at_once: int = 2_000) -> Iterator[bytes]:
        """Ids of pieces that are not known yet, each with what stands ``before`` it, encoded many in one call.

        Each begins with a visible character, so their joined text is encoded piece by piece; the number of
        bytes of the tokens tells where each piece ends.
        """
        for low in range(0, len(fresh), at_once):
            part = fresh[low : low + at_once]
            ids = self._ids(before + before.join(part))
            ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(piece.encode()) + 1 for piece in part])) + 1
            data, ends = ids.tobytes(), (4 * ends).tolist()
            yield from (data[a:b] for a, b in zip([0, *ends], ends))

    def _known(self, wanted: list[str]) -> dict[str, bytes]:
        """Ids of pieces, each encoded once. One that begins with a line feed follows that instead of a space."""
        found = dict.fromkeys(wanted)
        known, old, made, spaced, lines = self.memo, self.memo.old, {}, [], []
        for piece in found:
            ids = known.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is not None:
                    made[piece] = ids
                elif len(piece) > Memo.LONGEST:
                    ids = self._ids(piece if piece[0] == "\n" else " " + piece).tobytes()
                elif piece[0] == "\n":
                    lines.append(piece)
                else:
                    spaced.append(piece)
            found[piece] = ids
        made.update(zip(spaced, self._learn(spaced)))
        made.update(zip(lines, self._learn([piece[1:] for piece in lines], "\n")))
        found.update(made)
        known.put_all(made)
        return found

    def _ids_of(self, each: list[str]) -> list[bytes]:
        """Ids of different pieces. Their words are encoded once, whatever mark ends them and whatever line they are in."""
        marked = [piece[-1] in MARKS and piece[-2:-1] in LETTERS for piece in each]
        stems = [piece[:-1] if mark else piece for piece, mark in zip(each, marked)]
        parts = {at: words for at, piece in enumerate(each) if "\n" in piece and (words := words_of_lines(piece))}
        for at in parts:
            stems[at] = parts[at][0][0]
        found = self._known([*stems, *(word for words in parts.values() for word, _ in words[1:])])
        values = [found[stem] + self.marks[piece[-1]] if mark else found[stem] for stem, piece, mark in zip(stems, each, marked)]
        for at, words in parts.items():
            values[at] = b"".join(found[word] + self.marks[mark] for word, mark in words)
        return values

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text (null: none) as little-endian unsigned 32-bit integers.

        Texts are worked off in groups of about ``GROUP_CHARS`` characters or a single longer one. A text that holds an added
        token of the vocabulary is encoded whole: the library cuts it there first.
        """
        out, low, size = [], 0, 0
        for at, text in enumerate(texts):
            size += len(text) if text else 0
            if size >= GROUP_CHARS or at + 1 == len(texts):
                out += self._encode_group(texts[low : at + 1])
                low, size = at + 1, 0
        return out

    def _encode_group(self, texts: list[str | None]) -> list[bytes]:
        out, even, loose = [b""] * len(texts), [], []
        for at, text in enumerate(texts):
            if text and any(token in text for token in self.added):
                out[at] = self._ids(text).tobytes()
            elif text:
                (loose if is_loose(text) else even).append(at)
        parts = [pc.split_pattern(pa.array([texts[at] for at in even], pa.large_string()), " ")]
        parts.append(pa.array([pieces(texts[at]) for at in loose], pa.list_(pa.large_string())))
        for at, ids in zip([*even, *loose], chain.from_iterable(map(self._encode_pieces, parts))):
            out[at] = ids
        return out

    def _encode_pieces(self, parts: pa.ListArray) -> list[bytes]:
        """Ids of texts that are cut into pieces, at least one each."""
        if not len(parts):
            return []
        counts, flat = pc.list_value_length(parts).to_numpy().astype(np.int64), parts.flatten()
        heads = np.cumsum(counts) - counts
        after = np.ones(len(flat), bool)
        after[heads] = False
        coded = flat.filter(pa.array(after)).dictionary_encode()
        values = self._ids_of(coded.dictionary.to_pylist())
        # The ids of all pieces, one after the other.
        plain, codes = np.frombuffer(b"".join(values), "<u4"), coded.indices.to_numpy()
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        own = sizes[codes]
        ends = np.cumsum(own)
        ids = plain[np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        stops = (4 * np.concatenate([[0], ends])[np.cumsum(counts - 1)]).tolist()
        return [self.first[head] + ids[a:b] for head, a, b in zip(flat.take(pa.array(heads)).to_pylist(), [0, *stops], stops)]


_ENCODERS: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text", file_bytes: int = 1 << 28) -> DataFrame:
    """Encode whole texts and write the ids below ``folder`` in ascending order of ``key``.

    Rows are spread by ranges of the key (ties: by a hash of the text, so a hot key does not fill one task) and
    sorted inside them. A task begins a new file after ``file_bytes``. Files get new names in every attempt and
    only those of finished attempts are listed, so lost executors leave nothing wrong behind.
    Returns one row per file: part, file (order), path, n_docs, start (ids in all files before), n_tokens.
    ``docs`` may hold null keys (first) and null or empty texts (the end id only). Other columns are ignored.
    """
    kind = docs.schema[key].dataType
    spark = docs.sparkSession

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, done = piece_encoder(tokenizer), TaskContext.get().partitionId(), []
        store, base = open_store(folder)
        end = np.array([end_id], "<u4").tobytes()
        writer = None

        def close():
            writer.close()
            writer.sink.close()
            done.append((part, len(done), path, len(writer.keys), sum(writer.counts)))

        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                if writer is None:
                    path = f"{base}/part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.tokens"
                    writer = TokenWriter(store.open_output_stream(path, compression=None), batch.schema.types[0])
                writer.add(name, ids + end)
                if writer.written + writer.size >= file_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["part", "file", "path", "n_docs", "n_tokens"])

    store, base = open_store(folder)
    store.create_dir(base, recursive=True)
    ordered = docs.select(key, F.col(text).alias("t")).repartitionByRange(key, F.xxhash64("t")).sortWithinPartitions(key, F.xxhash64("t"))
    files = materialize(ordered.mapInArrow(write, "part bigint, file bigint, path string, n_docs bigint, n_tokens bigint"), "token-files")
    # One small row per file: the offsets of the files are their running sum.
    listed = sorted((tuple(row) for row in files.collect()), key=lambda row: row[:2])
    starts = [0, *accumulate(row[4] for row in listed)]
    rows = [(*row[:4], start, row[4]) for row, start in zip(listed, starts)]
    return spark.createDataFrame(rows, "part bigint, file bigint, path string, n_docs bigint, start bigint, n_tokens bigint")


def read_tokens(files: DataFrame, folder: str, key_type: str = "bigint", key: str = "doc_id") -> DataFrame:
    """Every document of the listed files: key, start (ids of all documents before), n_tokens, ids_crc32, part of the file."""
    schema = f"`{key}` {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint, file_path string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(folder)
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_file(path) as source:
                    reader = TokenReader(source)
                    n = len(reader.counts)
                    for low in range(0, n, 10_000):
                        high = min(n, low + 10_000)
                        crcs = [zlib.crc32(reader.document(i)) for i in range(low, high)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.concat_arrays(reader.keys.slice(low, high - low).chunks),
                                pa.array(start + reader.starts[low:high], pa.int64()), pa.array(reader.counts[low:high], pa.int64()),
                                pa.array(crcs, pa.int64()), pa.array([path] * (high - low)),
                            ],
                            [key, "start", "n_tokens", "ids_crc32", "file_path"],
                        )

    spread = files.select("path", "start").repartition(max(1, min(files.count(), MAX_READERS)), "path")
    return spread.mapInArrow(read, schema)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` to token files in a new scratch folder and return what reading them back gives."""
    spark: SparkSession = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    files = write_tokens(docs, folder, tokenizer, end_id, key, text)
    return read_tokens(files, folder, docs.schema[key].dataType.simpleString(), key)
