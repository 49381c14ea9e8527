"""Toxicity scores: two class-conditional Kneser-Ney models of spelling that back off to shared counts.

A model predicts every character of a text in lower case (one space between words, around the whole and at its end) from up
to ``ORDER - 1`` characters before it, also over the ends of words. From the labelled texts of each class come the counts of
the longest grams; all shorter grams have continuation counts, the number of different characters they are seen after (the
few that begin a text also what was seen). With n the counts of a gram (h, w), N(h) their sum over w and T(h) the number of different w::

    p(w)        = pooled continuations of both classes, add-one over the alphabet
    p(w | h, c) = (max(n_c(h, w) - D, 0) + D * T_c(h) * p(w | h', c)) / N_c(h)      h' is h without its first character

so rare expressions fall back to shorter ones and at last to counts that both classes share. Grams are exact for every alphabet:
two 64-bit numbers hold their characters and length. The counts are a table that grows with the labelled texts and is never
gathered or broadcast. Texts are scored in chunks: the distinct grams of a chunk are joined with the table, and what is
found meets the chunk again. A chunk ends after ``CHUNK_CHARS`` characters; a longer text is a chunk of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from caseloom.llm.text import mix, release
from caseloom.session import broadcast_if_small, materialize, open_store, scratch_path

# The alphabet has 2**CHAR_BITS characters, or as many as were seen if these are more.
ORDER, CHAR_BITS = 5, 10
# Bits of a code point. A gram's last three characters are in ``lo``, those before in ``hi`` below its length.
CODE_BITS, HIGH_BITS, LOW_BITS = 21, 42, 63
DISCOUNT = 0.75
# Characters of a chunk of texts, and of the part of it whose grams are made at once.
CHUNK_CHARS, PIECE_CHARS = 16_000_000, 500_000
# Rows of a block of the model.
BLOCK_ROWS = 1_000_000
# Penalty on the squared weights of the probability curve, on standardised inputs.
RIDGE = 0.3
# Lengths of the stretches whose highest mean ratio is taken.
WINDOWS = (8, 16, 32, 64)
# Stretches are also counted in spans of so many characters, of which the highest TOP count.
SPAN, TOP = 64, 3
# Label rows up to which they are broadcast (16 bytes each); beyond it texts and labels are shuffled.
LABEL_ROWS = 1_000_000
# Of a gram n, of a context the sum and the number of what follows.
COUNTS = ["n0", "n1", "sum0", "sum1", "kinds0", "kinds1"]


def units_of(text: str | None, across: bool) -> list[str]:
    """What a history does not leave: the whole text, or else each of its words."""
    words = text.lower().split() if text else []
    return [" ".join(words)] if across and words else words


def number_of(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of every key among the distinct ones, and for each of those a place where it stands. Keys are below ``size``."""
    kind = np.int32 if len(keys) < 1 << 31 else np.int64
    if size <= 8 * len(keys) + (1 << 16):
        # A table of all possible keys is cheaper than hashing them.
        table = np.full(size, -1, kind)
        table[keys] = np.arange(len(keys), dtype=kind)
        present = np.flatnonzero(table >= 0)
        one = table[present]
        table[present] = np.arange(len(present), dtype=kind)
        return table[keys], one
    coded = pa.array(keys).dictionary_encode()
    number = coded.indices.to_numpy()
    one = np.zeros(len(coded.dictionary), kind)
    one[number] = np.arange(len(keys), dtype=kind)
    return number, one


class Grams:
    """The distinct grams of some units, each found by adding a character to one that is shorter by one.

    They are numbered by length: ``hi``, ``lo`` spell a gram, ``context`` is the number of the gram without its last
    character, ``suffix`` of the gram without its first. ``ends`` has for every predicted character the longest
    gram that ends there, ``unit`` the number of its unit.
    """

    def __init__(self, units: list[str]):
        sizes = np.array([len(unit) + 2 for unit in units], np.int64)
        codes = np.frombuffer("".join(f" {unit} " for unit in units).encode("utf-32-le", "surrogatepass"), np.uint32)
        unit = np.repeat(np.arange(len(units)), sizes)
        starts = np.cumsum(sizes) - sizes
        at, first = number_of(codes.astype(np.int64), int(codes.max(initial=0)) + 1)
        chars = codes[first].astype(np.int64)
        letter, count = at, len(chars)
        # The places of the grams of a length: units stand together, each with one place less than for the length before.
        places, begins = np.arange(len(codes)), starts
        ends = np.zeros(len(codes), np.int64)
        hi, lo = [np.full(count, 1 << HIGH_BITS, np.int64)], [chars]
        none = np.full(count, -1, np.int64)
        context, suffix, self.starts = [none], [none], [0, count]
        for length in range(2, ORDER + 1):
            ends[places[begins]] = at[begins] + np.int64(self.starts[-2])
            longer = np.ones(len(places), bool)
            longer[begins] = False
            longer = longer[1:]
            shorter, letter, places = at[1:][longer], letter[1:][longer], places[1:][longer]
            most = (self.starts[-1] - self.starts[-2]) * count
            key = at[:-1][longer].astype(np.int32 if most < 1 << 31 else np.int64) * count + letter
            found, one = number_of(key, most)
            before, char = np.divmod(key[one].astype(np.int64), count)
            char = chars[char]
            high = ((hi[-1][before] << CODE_BITS) | (lo[-1][before] >> HIGH_BITS)) & ((1 << HIGH_BITS) - 1)
            lo.append(((lo[-1][before] << CODE_BITS) | char) & ((1 << LOW_BITS) - 1))
            hi.append(high | (length << HIGH_BITS))
            context.append(before + self.starts[-2])
            suffix.append(shorter[one] + np.int64(self.starts[-2]))
            sizes = sizes[sizes > 1] - 1
            at, begins = found, np.cumsum(sizes) - sizes
            self.starts.append(self.starts[-1] + len(one))
        ends[places] = at + np.int64(self.starts[-2])
        self.hi, self.lo, self.context, self.suffix = (np.concatenate(x) for x in (hi, lo, context, suffix))
        predicted = np.ones(len(codes), bool)
        predicted[starts] = False
        self.ends, self.unit = ends[predicted], unit[predicted]

    def ratios(self, counts: dict[str, np.ndarray], total: int, alphabet: int) -> np.ndarray:
        """Of every gram log p(toxic) - log p(ordinary) of its last character, by its counts and those of the shorter ones."""
        base = (1.0 + counts["n0"][: self.starts[1]] + counts["n1"][: self.starts[1]]) / (alphabet + total)
        p = [np.concatenate([base, np.zeros(self.starts[-1] - len(base))]) for _ in (0, 1)]
        for low, high in zip(self.starts[1:-1], self.starts[2:]):
            part, h, back = slice(low, high), self.context[low:high], self.suffix[low:high]
            for c in (0, 1):
                n, seen = counts[f"n{c}"][part], counts[f"sum{c}"][h]
                mixed = (np.maximum(n - DISCOUNT, 0) + DISCOUNT * counts[f"kinds{c}"][h] * p[c][back]) / np.maximum(seen, 1)
                p[c][part] = np.where(seen > 0, np.minimum(mixed, 1.0), p[c][back])
        return np.log(np.maximum(p[1], 1e-300)) - np.log(np.maximum(p[0], 1e-300))


def count_grams(texts: DataFrame, across: bool) -> DataFrame:
    """Counts of the longest grams over rows (text, class): hi, lo, n0, n1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, classes, size = [], [], 0

        def out():
            grams, toxic = Grams(units), np.array(classes, np.int64)
            sums = [np.bincount(grams.ends[toxic[grams.unit] == c], minlength=grams.starts[-1]) for c in (0, 1)]
            seen = np.flatnonzero(sums[0] + sums[1])
            for low in range(0, len(seen), 100_000):
                part = seen[low : low + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(x[part].astype(np.int64)) for x in (grams.hi, grams.lo, *sums)], ["hi", "lo", "n0", "n1"])

        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                for unit in units_of(value.as_py(), across):
                    units.append(unit)
                    classes.append(toxic)
                    size += len(unit) + 2
                if size >= PIECE_CHARS:
                    yield from out()
                    units, classes, size = [], [], 0
        if units:
            yield from out()

    partial = texts.mapInArrow(count, "hi bigint, lo bigint, n0 bigint, n1 bigint")
    return partial.groupBy("hi", "lo").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def length_of(hi):
    return F.shiftright(hi, HIGH_BITS)


def last_of(length):
    """The last ``length`` characters (a column) of the gram (hi, lo)."""
    high = F.when(length >= 5, F.col("hi").bitwiseAND((1 << HIGH_BITS) - 1)).when(length == 4, F.col("hi").bitwiseAND((1 << CODE_BITS) - 1)).otherwise(F.lit(0).cast("long"))
    low = F.when(length >= 3, F.col("lo")).when(length == 2, F.col("lo").bitwiseAND((1 << HIGH_BITS) - 1)).otherwise(F.col("lo").bitwiseAND((1 << CODE_BITS) - 1))
    return F.struct(high.bitwiseOR(F.shiftleft(length, HIGH_BITS)).alias("hi"), low.alias("lo"))


def kneser_ney_counts(longest: DataFrame) -> DataFrame:
    """Counts of the grams of every length: as seen for the longest and those that begin a unit, plus those of continuations."""
    lengths = F.sequence(F.lit(2).cast("long"), length_of("hi"))
    parts = longest.select(F.explode(F.transform(lengths, last_of)).alias("gram"), (F.col("n0") > 0).alias("p0"), (F.col("n1") > 0).alias("p1"))
    present = parts.groupBy("gram.hi", "gram.lo").agg(F.max("p0").alias("p0"), F.max("p1").alias("p1"))
    shorter = present.select(last_of(length_of("hi") - 1).alias("gram"), "p0", "p1")
    continued = shorter.select("gram.hi", "gram.lo", F.col("p0").cast("long").alias("n0"), F.col("p1").cast("long").alias("n1"))
    return longest.select("hi", "lo", "n0", "n1").unionByName(continued).groupBy("hi", "lo").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


@dataclass
class Models:
    """Both models: a row per gram and context (hi, lo and COUNTS), the sum of the characters' counts and the alphabet's size."""

    rows: DataFrame
    size: int
    total: int
    alphabet: int
    across: bool

    def ratios(self, words: list[str]) -> np.ndarray:
        """Sum over the characters of each word of log p(toxic) - log p(ordinary)."""
        docs = self.rows.sparkSession.createDataFrame(list(enumerate(words)), "doc_id bigint, text string")
        found = {row.doc_id: row.log_ratio * row.n_chars for row in log_ratios(docs, self).collect()}
        return np.array([found[i] for i in range(len(words))])


def train(texts: DataFrame, across: bool = False) -> Models:
    """Both models from rows (text, class); ``across`` lets the history run over the ends of words."""
    counts = materialize(kneser_ney_counts(materialize(count_grams(texts, across), "grams")), "counts")
    high = F.shiftright(F.col("hi").bitwiseAND((1 << HIGH_BITS) - 1), CODE_BITS).bitwiseOR(F.shiftleft(length_of("hi") - 1, HIGH_BITS))
    low = F.shiftright("lo", CODE_BITS).bitwiseOR(F.shiftleft(F.col("hi").bitwiseAND((1 << CODE_BITS) - 1), HIGH_BITS))
    sums = [F.sum(f"n{c}").alias(f"sum{c}") for c in (0, 1)] + [F.count(F.when(F.col(f"n{c}") > 0, 1)).alias(f"kinds{c}") for c in (0, 1)]
    contexts = counts.where(length_of("hi") > 1).groupBy(high.alias("hi"), low.alias("lo")).agg(*sums)
    zero = F.lit(0).cast("long")
    both = counts.select("hi", "lo", "n0", "n1", *[zero.alias(name) for name in COUNTS[2:]]).unionByName(contexts.select("hi", "lo", zero.alias("n0"), zero.alias("n1"), *COUNTS[2:]))
    rows = materialize(both.groupBy("hi", "lo").agg(*[F.sum(name).alias(name) for name in COUNTS]), "models")
    one = counts.where(length_of("hi") == 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("n0") + F.col("n1")), zero).alias("total")).first()
    return Models(rows, rows.count(), one.total, max(1 << CHAR_BITS, one.n), across)


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, 64 bits an entry, one after the other, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(x, "<i8").tobytes() for x in arrays))


def _unzip(data: bytes, count: int) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i8").reshape(count, -1)


def spread_of(hi: np.ndarray, lo: np.ndarray, blocks: int) -> np.ndarray:
    """The block of the model that holds a gram."""
    return (mix(hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + lo.astype(np.uint64)) % np.uint64(blocks)).astype(np.int64)


def _order(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return np.lexsort((lo, hi))


def distinct_grams(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all parts, each once and in order."""
    hi, lo = (np.concatenate(x) for x in zip(*parts))
    order = _order(hi, lo)
    hi, lo = hi[order], lo[order]
    first = np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])))[: len(hi)]
    return hi[first], lo[first]


class GramIndex:
    """Places of grams in a list sorted by (hi, lo); made once for all searches in the list."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        # The ranks of both numbers make one that keeps the order.
        (self.highs, high), (self.lows, low) = np.unique(hi, return_inverse=True), np.unique(lo, return_inverse=True)
        self.own = high * len(self.lows) + low

    def find(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The places, -1 for grams that the list lacks."""
        if not len(self.own):
            return np.full(len(hi), -1)
        a, b = np.searchsorted(self.highs, hi), np.searchsorted(self.lows, lo)
        a[a == len(self.highs)], b[b == len(self.lows)] = 0, 0
        wanted = a * len(self.lows) + b
        place = np.searchsorted(self.own, wanted)
        place[place == len(self.own)] = 0
        return np.where((self.highs[a] == hi) & (self.lows[b] == lo) & (self.own[place] == wanted), place, -1)


def find_grams(hi: np.ndarray, lo: np.ndarray, of_hi: np.ndarray, of_lo: np.ndarray) -> np.ndarray:
    """Places of grams in a list sorted by (hi, lo), -1 where it lacks them."""
    return GramIndex(of_hi, of_lo).find(hi, lo)


def window_ratios(ratios: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per text (its characters stand together) for each of WINDOWS the highest mean ratio of a stretch of that length, and the
    mean of the TOP highest, one for every SPAN characters in which stretches begin.

    One expression makes the first high, several in different places also the second. A text shorter than a stretch counts its
    whole sum; a text with fewer spans takes the mean over those it has; without characters all are 0.
    """
    total = np.concatenate(([0.0], np.cumsum(ratios)))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    best = np.zeros((len(sizes), 2 * len(WINDOWS)))
    if not len(ratios):
        return best
    of_text = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(ratios)) - starts[of_text]
    heads = np.flatnonzero(inside % SPAN == 0)
    span_text = of_text[heads]
    filled, first = np.unique(span_text, return_index=True)
    rank = np.arange(len(heads)) - np.repeat(first, np.diff(np.append(first, len(heads))))
    counted = rank < TOP
    left = ends[of_text] - np.arange(len(ratios))
    for j, length in enumerate(WINDOWS):
        sums = np.empty(len(ratios))
        whole = max(0, len(ratios) - length + 1)
        sums[:whole] = total[length:] - total[:whole]
        # A stretch that would leave its text begins at the last place that does not.
        late = np.flatnonzero(left < length)
        stop = ends[of_text[late]]
        sums[late] = total[stop] - total[np.maximum(stop - length, starts[of_text[late]])]
        highest = np.maximum.reduceat(sums, heads) / length
        order = np.lexsort((-highest, span_text))
        best[filled, 2 * j] = highest[order][first]
        best[:, 2 * j + 1] = np.bincount(span_text[counted], highest[order][counted], len(sizes)) / np.maximum(1, np.bincount(span_text[counted], minlength=len(sizes)))
    return best


def log_ratios(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text", carry: str | None = None) -> DataFrame:
    """Key, number of words, characters, mean log-likelihood ratio per character and highest means over WINDOWS of every row.

    Texts are held in chunks of up to ``CHUNK_CHARS`` characters, worked off ``PIECE_CHARS`` at a time. The model lies in
    blocks by hash; a chunk sends each block one packed, sorted list of its distinct grams and gets their counts back, as a file of
    the shared folder, so that the texts themselves are stored once and never shuffled.
    """
    kept = [key] + [carry] * (carry is not None)
    kinds = [f"`{name}` {docs.schema[name].dataType.simpleString()}" for name in kept]
    across, total, alphabet = models.across, models.total, models.alphabet
    blocks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-models.size // BLOCK_ROWS))
    folder = scratch_path(docs.sparkSession, "answers")
    # Results are compared with types whose fields may all be null.
    types = to_arrow_schema(StructType.fromDDL(", ".join(kinds))).types

    def pieces_of(texts: list[str | None]) -> Iterator[tuple[int, int, Grams, np.ndarray]]:
        """Consecutive texts (first, end) with their grams and the text of each unit."""
        low, held = 0, 0
        for at, value in enumerate(texts):
            held += len(value) if value else 0
            if held >= PIECE_CHARS or at + 1 == len(texts):
                units = [units_of(x, across) for x in texts[low : at + 1]]
                yield low, at + 1, Grams([u for part in units for u in part]), np.repeat(np.arange(at + 1 - low), [len(part) for part in units])
                low, held = at + 1, 0

    def stored(table: pa.Table) -> bytes:
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))) as out:
            out.write_table(table)
        return stream.getvalue().to_pybytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        names = ["chunk", "block", "data"]

        def out():
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            merged, new = (np.zeros(0, np.int64), np.zeros(0, np.int64)), []
            for _, _, grams, _ in pieces_of(table.column(len(kept)).to_pylist()):
                new.append((grams.hi, grams.lo))
                # Sorting again for every piece would cost the square of their number.
                if sum(len(part[0]) for part in new) > len(merged[0]):
                    merged, new = distinct_grams([merged, *new]), []
            hi, lo = distinct_grams([merged, *new])
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([-1], pa.int32()), pa.array([stored(table)], pa.binary())], names)
            of_block = spread_of(hi, lo, blocks)
            for b in np.unique(of_block).tolist():
                mine = of_block == b
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([b], pa.int32()), pa.array([_zip(hi[mine], lo[mine])], pa.binary())], names)

        for batch in batches:
            low, lengths = 0, [len(value) if value else 0 for value in batch.column(len(kept)).to_pylist()]
            for at, length in enumerate(lengths):
                size += length
                if size >= CHUNK_CHARS:
                    held.append(batch.slice(low, at + 1 - low))
                    yield from out()
                    chunk, held, size, low = chunk + 1, [], 0, at + 1
            if low < len(lengths):
                held.append(batch.slice(low))
        if held:
            yield from out()
        release()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The model's rows with their block."""
        for batch in batches:
            hi, lo = (batch.column(i).to_numpy() for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(spread_of(hi, lo, blocks).astype(np.int32)), *batch.columns], ["block", "hi", "lo", *COUNTS])

    def answer(group: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        hi, lo = (right.column(name).to_numpy() for name in ("hi", "lo"))
        order = _order(hi, lo)
        hi, lo = hi[order], lo[order]
        counts, index = [right.column(name).to_numpy()[order] for name in COUNTS], GramIndex(hi, lo)
        chunk, found = left.column("chunk").to_pylist(), []
        for data in left.column("data"):
            wanted = _unzip(data.as_py(), 2)
            at = index.find(wanted[0], wanted[1])
            seen = at >= 0
            found.append(_zip(wanted[0][seen], wanted[1][seen], *(c[at[seen]] for c in counts)))
        return pa.Table.from_arrays([pa.array(chunk, pa.int64()), pa.array(found, pa.binary())], ["chunk", "found"])

    def keep(group: tuple, table: pa.Table) -> pa.Table:
        """The answers to a chunk as a file of its number: made under another name, so it is whole or not there, in any attempt."""
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        made = f"{base}/{uuid.uuid4().hex}"
        with store.open_output_stream(made) as out, pa.ipc.new_stream(out, table.select(["found"]).schema) as rows:
            rows.write_table(table.select(["found"]))
        store.move(made, f"{base}/{group[0].as_py()}")
        return table.select(["chunk"]).slice(0, 1)

    def answers_to(chunk: int) -> list[np.ndarray]:
        store, base = open_store(folder)
        name = f"{base}/{chunk}"
        if store.get_file_info(name).type == fs.FileType.NotFound:
            return []
        with store.open_input_stream(name) as data:
            found = pa.ipc.open_stream(data).read_all().column("found")
        return [_unzip(x.as_py(), 2 + len(COUNTS)) for x in found]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from score(batch.column("chunk")[i].as_py(), batch.column("data")[i].as_py()).to_batches()

    def score(chunk: int, data: bytes) -> pa.Table:
        table = pa.ipc.open_stream(data).read_all()
        texts = table.column(len(kept)).to_pylist()
        parts = answers_to(chunk) or [np.zeros((2 + len(COUNTS), 0), np.int64)]
        hi, lo = (np.concatenate([part[i] for part in parts]) for i in (0, 1))
        order = _order(hi, lo)
        known = [np.concatenate([part[2 + i] for part in parts])[order] for i in range(len(COUNTS))]
        index = GramIndex(hi[order], lo[order])
        del parts, hi, lo, order
        sums, chars, best = np.zeros(len(texts)), np.zeros(len(texts), np.int64), np.zeros((len(texts), 2 * len(WINDOWS)))
        for low, end, grams, of_unit in pieces_of(texts):
            at = index.find(grams.hi, grams.lo)
            counts = {name: np.where(at >= 0, values[at] if len(values) else 0, 0).astype(np.float64) for name, values in zip(COUNTS, known)}
            each = of_unit[grams.unit] if len(of_unit) else np.zeros(0, np.int64)
            ratios = grams.ratios(counts, total, alphabet)[grams.ends]
            sizes = np.bincount(each, minlength=end - low).astype(np.int64)
            sums[low:end], chars[low:end] = np.bincount(each, ratios, end - low), sizes
            best[low:end] = window_ratios(ratios, sizes)
            del grams, at, counts, each, ratios
        words = [len(value.split()) if value else 0 for value in texts]
        release()
        columns = [pa.array(words, pa.int64()), pa.array(chars), pa.array(sums / np.maximum(chars, 1))]
        windows = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * best.shape[1]), pa.array(best.ravel()))
        return pa.Table.from_arrays([*(column.cast(kind) for column, kind in zip(table.columns, types)), *columns, windows], [*kept, "n_words", "n_chars", "log_ratio", "windows"])

    chunks = materialize(docs.select(*kept, text).mapInArrow(cut, "chunk bigint, block int, data binary"), "chunks")
    model = models.rows.select("hi", "lo", *COUNTS).mapInArrow(place, "block int, hi bigint, lo bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
    asked = chunks.where("block >= 0").groupBy("block")
    answers = asked.cogroup(model.groupBy("block")).applyInArrow(answer, "chunk bigint, found binary")
    answers.groupBy("chunk").applyInArrow(keep, "chunk bigint").write.format("noop").mode("overwrite").save()
    return chunks.where("block < 0").select("chunk", "data").mapInArrow(scores, ", ".join([*kinds, "n_words bigint, n_chars bigint, log_ratio double, windows array<double>"]))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0, ridge: float = 0.01, steps: int = 100) -> np.ndarray:
    """Weights of a logistic regression whose first column is constant: Newton steps on standardised columns, halved until the loss falls."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[0], spread[0] = 0.0, 1.0
    spread[spread == 0] = 1.0
    z = (x - mean) / spread
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6

    def loss(w: np.ndarray) -> float:
        score = z @ w
        return float((weight * (np.logaddexp(0, score) - y * score)).sum() + 0.5 * (penalty * w * w).sum())

    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -500, 500)))
        slope = z.T @ (weight * (p - y)) + penalty * w
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(penalty), slope)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    w = w / spread
    w[0] -= (w * mean)[1:].sum()
    return w


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held: int = 1, key: str = "doc_id", text: str = "text",
                    label: str = "toxic", calibration_rows: int = 100_000, carry: str | None = None) -> DataFrame:
    """Toxicity of every whole text, learnt from the labelled rows outside the held-out fold.

    A row is held out if crc32 of its key as text leaves ``held`` modulo ``folds``. Of the others, a fifth (by hash of the key) is
    not counted but calibrates the probability: a logistic curve over length-normalised log-likelihood ratios, that of the whole
    text and the highest of its stretches of WINDOWS characters (see ``window_ratios``), fitted to the ``calibration_rows`` of each class that
    are first by hash, weighted to the number of its rows; all the rest is counted. If the
    fifth or the rest lacks a class, all labelled rows are counted and the same curve is fitted to them. Labels, language, source and key are
    never inputs of a score. Every label row counts once; labels other than 0 and 1 and null keys are left out. Without
    labels of both classes all scores are 0. Texts without words, null ones too, have ratio and score 0. Rows without key are
    scored and not held out. Repeated rows stay, other columns are ignored, an empty table gives an empty result.
    Returns the key, the column ``carry`` if named, held_out, score, predicted (1 from ``threshold`` on), n_words and log_ratio.
    """
    fold = F.coalesce(F.crc32(F.col(key).cast("string")) % folds == held, F.lit(False))
    fifth = F.pmod(F.xxhash64(key), F.lit(5)) == 0
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~fold).select(key, F.col(label).cast("int").alias("class"))
    worded = docs.where(F.col(text).rlike(r"\S")).select(key).join(broadcast_if_small(known, LABEL_ROWS), key)
    sizes = {(row.spare, row["class"]): row["count"] for row in worded.groupBy(fifth.alias("spare"), "class").count().collect()}
    # With a class missing in the fifth or in the rest, the same rows are counted and fitted to.
    apart = all((part, c) in sizes for part in (False, True) for c in (0, 1))
    of_class = [sizes.get((True, c), 0) + (0 if apart else sizes.get((False, c), 0)) for c in (0, 1)]
    small = broadcast_if_small(known.where(~fifth) if apart else known, LABEL_ROWS)
    models = train(docs.select(key, F.col(text).alias("text")).join(small, key).select("text", "class"), across=True)
    scored = materialize(log_ratios(docs, models, key, text, carry), "ratios")
    if min(of_class):
        spare = scored.where((F.col("n_words") > 0) & (fifth if apart else F.lit(True))).join(known, key)
        drawn = [spare.where(F.col("class") == c).orderBy(F.xxhash64(key, F.lit(1))).limit(calibration_rows).select("log_ratio", "windows", "class").collect() for c in (0, 1)]
        rows = [row for part in drawn for row in part]
        x = np.array([[1.0, row["log_ratio"], *row["windows"]] for row in rows])
        y = np.array([row["class"] for row in rows], float)
        w = logistic(x, y, np.where(y == 1, of_class[1] / len(drawn[1]), of_class[0] / len(drawn[0])), ridge=RIDGE)
        z = F.lit(float(w[0])) + F.col("log_ratio") * float(w[1])
        for j in range(2 * len(WINDOWS)):
            z = z + F.col("windows")[j] * float(w[2 + j])
        score = F.when(F.col("n_words") == 0, 0.0).otherwise(1 / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), z)))))
    else:
        score = F.lit(0.0)
    return scored.select(key, *([carry] if carry else []), fold.alias("held_out"), score.alias("score"), (score >= threshold).cast("int").alias("predicted"), "n_words", "log_ratio")


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, whole, that are not predicted toxic. A row is judged by its own text, also where a key repeats."""
    mark = F.xxhash64(text)
    # Scores belong to texts: the key travels for the labels, the hash of the text for rows that share a key.
    marked = docs.select(F.struct(F.col(key).alias("key"), mark.alias("mark")).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    scored = toxicity_scores(marked, labels.withColumnRenamed(key, "key"), threshold, key="key", text="text", carry="row", **options)
    rejected = scored.where("predicted = 1").select(F.col("row.key").alias("rejected_key"), F.col("row.mark").alias("rejected_mark")).distinct()
    same = docs[key].eqNullSafe(rejected["rejected_key"]) & (F.xxhash64(docs[text]) == rejected["rejected_mark"])
    return docs.join(rejected, same, "left_anti")
