"""Benchmark decontamination by spaced seeds: masks that ignore some word positions find overlaps despite substitutions.

Every window gets one hash per mask from the words the mask keeps: windows of 12 words, for items of 8 to 11 words of 8,
and for items of 5 to 7 words of 5. Windows of documents and of benchmark items with equal hashes are hits; around a hit
the two texts are aligned and compared word by word. A document is contaminated if 12 of 16 aligned words in a row are
equal (of a shorter item three quarters of its words), or if an aligned stretch, in which every substituted word costs
two matching ones, holds 12 equal words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.text import column_word_hashes, multipliers
from caseloom.session import materialize

# Window lengths, and how many of the four residues of a position modulo 4 the masks of that length keep. All choices of
# residues are masks, so one substitution in 5 words and two in 8 or 12 words leave a mask whole, wherever they fall.
SPANS = {5: 3, 8: 2, 12: 2}
# Fixed masks of windows of 12 words beside those: 1 keeps a position.
EXTRA_MASKS = ("100011110001", "110000101101")
# Items of fewer words say nothing: they never match.
LEAST_WORDS = 5
# The share of equal words that the stretch of an overlap needs.
SHARE = 0.75
# The filter of benchmark hashes has this many bits (8 MB), whatever the benchmark.
FILTER_BITS, BLOCK_BITS = 26, 16
# Windows hashed at once.
CHUNK = 1 << 19


def masks(span: int) -> list[list[int]]:
    """The positions that each mask of a window length keeps."""
    kept = [[i for i in range(span) if i % 4 in residues] for residues in combinations(range(4), SPANS[span])]
    return kept + [[i for i, c in enumerate(mask) if c == "1"] for mask in EXTRA_MASKS if len(mask) == span]


def span_of(n: int) -> int:
    """The window length of an item of ``n`` words."""
    return max(s for s in SPANS if s <= n)


def window_hashes(words: np.ndarray, span: int) -> Iterator[np.ndarray]:
    """Hashes of all windows of ``span`` words, one array per mask."""
    count = len(words) - span + 1
    if count <= 0:
        return
    factors = multipliers(1000 + span, span)
    scaled = [words[i : i + count] * factors[i] for i in range(span)]
    residues = [sum(scaled[r + 4 :: 4], start=scaled[r]) for r in range(4)]
    for number, kept in enumerate(masks(span)):
        whole = SPANS[span] if number < math.comb(4, SPANS[span]) else 0
        parts = [residues[r] for r in sorted({i % 4 for i in kept})] if whole else [scaled[i] for i in kept]
        yield sum(parts[1:], start=parts[0] + np.uint64((span * 16 + number) * 0x9E3779B97F4A7C15 % 2**64))


def filter_bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash in the filter."""
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64), (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def benchmark_windows(benchmark: DataFrame, item: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Items (item, words as 64-bit hashes, n) and their windows (hash, item, at). Repeated items count once."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, words, ends in column_word_hashes(batch.column(1)):
                sides = np.split(words, ends[:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0)[first : first + len(ends)], pa.array([w.tobytes() for w in sides], pa.binary()), pa.array(np.diff(ends, prepend=0))], ["item", "item_words", "n"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1).to_pylist()):
                words = np.frombuffer(data, np.uint64)
                for hashes in window_hashes(words, span_of(len(words))):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array([name.as_py()] * len(hashes), batch.schema.types[0]), pa.array(np.arange(len(hashes)))], ["hash", "item", "at"])

    kind = benchmark.schema[item].dataType.simpleString()
    spelled = benchmark.select(F.col(item).alias("item"), F.col(text).alias("t")).mapInArrow(spell, f"item {kind}, item_words binary, n bigint")
    items = materialize(spelled.where(F.col("n") >= LEAST_WORDS).dropDuplicates(["item", "item_words"]), "items")
    return items, materialize(items.select("item", "item_words").mapInArrow(cut, f"hash bigint, item {kind}, at bigint").distinct(), "windows")


def build_filter(windows: DataFrame) -> np.ndarray:
    """The set bits of all benchmark hashes, gathered as at most ``2**(FILTER_BITS - BLOCK_BITS)`` packed blocks of 8 KB."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(np.concatenate(filter_bits(batch.column(0).to_numpy().view(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["bit"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        block = np.zeros(1 << BLOCK_BITS, bool)
        block[table.column("bit").to_numpy() & ((1 << BLOCK_BITS) - 1)] = True
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "data": pa.array([np.packbits(block).tobytes()], pa.binary())})

    set_bits = windows.select("hash").mapInArrow(bits, "bit bigint").distinct()
    packed = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (BLOCK_BITS - 3)
    for row in set_bits.groupBy(F.shiftright("bit", BLOCK_BITS).alias("block")).applyInArrow(pack, "block bigint, data binary").collect():
        packed[row.block * width : (row.block + 1) * width] = np.frombuffer(row.data, np.uint8)
    return packed


def best_stretch(equal: np.ndarray) -> tuple[int, int, int]:
    """The stretch with the highest count of equal words minus twice the others: equal words, start, end."""
    gain = np.cumsum(np.where(equal, 1, -2))
    before = np.concatenate([[0], gain[:-1]])
    lowest = np.minimum.accumulate(before)
    end = int(np.argmax(gain - lowest))
    start = int(np.argmin(before[: end + 1]))
    return int(equal[start : end + 1].sum()), start, end + 1


def verified(equal: np.ndarray, n: int, least: int = 12) -> tuple[int, int, int] | None:
    """Equal words, start and end of the stretch that proves an overlap with an item of ``n`` words, if there is one.

    ``equal`` tells of each aligned word whether both texts have it; beyond the document's ends there is none.
    """
    matched, start, end = best_stretch(equal)
    if matched >= least:
        return matched, start, end
    needed = min(least, math.ceil(SHARE * n))
    width = min(n, math.ceil(least / SHARE), len(equal))
    sums = np.concatenate([[0], np.cumsum(equal)])
    inside = sums[width:] - sums[:-width]
    at = int(np.argmax(inside))
    return (int(inside[at]), at, at + width) if inside[at] >= needed else None


def find_overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Verified overlaps: one row per (document key, text hash, item) with matched, n, doc_at, length of the best stretch.

    An overlap is a stretch as ``verified`` finds it. Documents are scanned once against a filter of fixed size; only
    those with hits go on, with their words. Joins are plain equi-joins on hashes, items and documents, so hot hashes
    can be split.
    """
    spark = docs.sparkSession
    items, windows = benchmark_windows(benchmark, item, item_text)
    lengths = items.select(F.least("n", F.lit(max(SPANS))).alias("n")).distinct().collect()
    spans = sorted({span_of(row.n) for row in lengths})  # three values at most
    held = spark.sparkContext.broadcast(build_filter(windows))
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value

        def hits(hashes):
            """Places whose hash has both bits in the filter; most fail by the byte of the first bit alone."""
            at = np.flatnonzero(known[hashes >> np.uint64(67 - FILTER_BITS)])
            one, two = ((known[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 for bit in filter_bits(hashes[at]))
            return at[(one & two) == 1]

        for batch in batches:
            rows = []
            for first, words, ends in column_word_hashes(batch.column(2)):
                found = []
                for span in spans:
                    for low in range(0, len(words), CHUNK):
                        for hashes in window_hashes(words[low : low + CHUNK + span - 1], span):
                            at = hits(hashes)
                            place = low + at
                            row = np.searchsorted(ends, place, side="right")
                            whole = place + span <= ends[row]
                            found.append((row[whole], place[whole], hashes[at[whole]]))
                if not found:
                    continue
                row, place, hashes = (np.concatenate(x) for x in zip(*found))
                order = np.argsort(row, kind="stable")
                row, place, hashes = row[order], place[order], hashes[order].view(np.int64)
                bounds = np.flatnonzero(np.diff(row, prepend=-1, append=len(ends)))
                for a, b in zip(bounds[:-1], bounds[1:]):
                    begin = int(ends[row[a] - 1]) if row[a] else 0
                    rows.append((first + int(row[a]), words[begin : ends[row[a]]].tobytes(), hashes[a:b], place[a:b] - begin))
            if rows:
                at, texts, hashes, places = zip(*rows)
                taken = batch.select([0, 1]).take(pa.array(at))
                numbers = [pa.array(c, pa.list_(pa.int64())) for c in (hashes, places)]
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(texts, pa.binary()), *numbers], ["key", "mark", "words", "hashes", "places"])

    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("t"))
    found = materialize(rows.mapInArrow(scan, f"key {kind}, mark bigint, words binary, hashes array<bigint>, places array<bigint>"), "hits")
    pairs = found.select("key", "mark", F.explode(F.arrays_zip("hashes", "places")).alias("hit")).select("key", "mark", F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("place"))
    aligned = pairs.join(windows, "hash").select("key", "mark", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    whole = found.select(F.col("key").alias("k"), F.col("mark").alias("m"), "words").dropDuplicates(["k", "m"])
    both = aligned.join(items, "item").join(whole, F.col("key").eqNullSafe(F.col("k")) & (F.col("mark") == F.col("m")))
    # Only the part of the document beside the item travels on.
    first = F.greatest(F.col("shift"), F.lit(0))
    part = F.substring("words", (8 * first + 1).cast("int"), (8 * (F.col("shift") + F.col("n") - first)).cast("int"))
    sides = both.select("key", "mark", "item", "shift", "n", "item_words", part.alias("part"))
    kinds = {"key": kind, "item": benchmark.schema[item].dataType.simpleString()}

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, mark, which, shift, n, item_words, part in zip(*(column.to_pylist() for column in batch.columns)):
                theirs, ours = np.frombuffer(item_words, np.uint64), np.frombuffer(part, np.uint64)
                skipped = max(0, -shift)
                theirs = theirs[skipped : skipped + len(ours)]
                if proof := verified(theirs == ours[: len(theirs)], n, least):
                    matched, start, end = proof
                    rows.append((name, mark, which, matched, n, max(shift, 0) + start, end - start))
            if rows:
                types = [batch.schema.types[0], pa.int64(), batch.schema.types[2], *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "mark", "item", "matched", "n", "doc_at", "length"])

    checked = sides.mapInArrow(verify, f"key {kinds['key']}, mark bigint, item {kinds['item']}, matched bigint, n bigint, doc_at bigint, length bigint")
    best = F.max_by(F.struct("matched", "n", "doc_at", "length"), F.struct("matched", (-F.col("doc_at")).alias("d"))).alias("best")
    return checked.groupBy("key", "mark", "item").agg(best).select("key", "mark", "item", "best.*")


def contamination(docs: DataFrame, benchmark: DataFrame, least: int = 12, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every row of ``docs`` with what was found in it: key, contaminated, n_items, items (sorted), matched (most words), mark.

    Words are compared in lower case without marks at their edges. Null and empty texts are clean, as are items of fewer
    than five words. Rows repeated, or of one key with different texts, are decided by their own text; a null key is a
    key like others. Items of one id with different texts count as one id. Other columns are ignored; an empty table or
    benchmark finds nothing.
    """
    overlaps = find_overlaps(docs, benchmark, least, key, text, item, item_text)
    per_doc = overlaps.groupBy("key", "mark").agg(F.sort_array(F.collect_set("item")).alias("items"), F.max("matched").alias("matched"))
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("m"))
    joined = rows.join(per_doc, F.col("k").eqNullSafe(F.col("key")) & (F.col("m") == F.col("mark")), "left")
    none = F.array().cast(per_doc.schema["items"].dataType)
    return joined.select(
        F.col("k").alias(key), F.col("items").isNotNull().alias("contaminated"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", none).alias("items"), F.coalesce("matched", F.lit(0)).cast("bigint").alias("matched"), F.col("m").alias("mark"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs``, whole, whose text holds no verified overlap.

    All columns stay, whatever their names. Rows with a null or empty text stay; repeated rows and rows of a null key are
    decided by their own text, each for itself. An empty table or benchmark removes nothing.
    """
    flagged = find_overlaps(docs, benchmark, key=key, text=text, **options).select("key", F.col("mark").alias("found_mark")).distinct()
    same = docs[key].eqNullSafe(flagged["key"]) & (F.xxhash64(docs[text]) == flagged["found_mark"])
    return docs.join(flagged, same, "left_anti")
