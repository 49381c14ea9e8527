"""Removal of byte strings that occur more than once, decided by suffix arrays of shards built by induced sorting.

Every window of ``WINDOW`` bytes belongs to the place inside it whose gram of ``GRAM`` bytes has the smallest hash. Windows
with equal bytes have equal such grams at equal places, so they meet in the shard of that gram. Neighbouring windows of a
document with the same place form a region; only regions whose gram occurs elsewhere go to a shard, equal regions once with
their number. In a shard the suffix array of all regions and its permuted common prefixes tell which windows occur twice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.text import mix
from caseloom.session import materialize

WINDOW, GRAM = 400, 32
# Bytes of regions in a shard, and different regions of one gram that a shard may hold.
SHARD_BYTES, MAX_REGIONS = 1_000_000, 4_000
# Never part of UTF-8: ends a region inside a shard.
SEPARATOR = 255


# --- suffix arrays


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it. The empty suffix is the smallest."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    # In a run of equal characters the first difference after it decides.
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    following = np.minimum.accumulate(at[::-1])[::-1] if n > 1 else at
    smaller = np.zeros(n, bool)
    inside = following < n - 1
    smaller[:-1][inside] = step[following[inside]] > 0
    return smaller


def _induce_by_bucket(text: np.ndarray, smaller: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Induce the order of all suffixes from the given order of leftmost-smaller ones, one bucket at a time as arrays."""
    n = len(text)
    counts = np.bincount(text, minlength=size)
    tail = np.cumsum(counts)
    head = tail - counts
    order = np.full(n, -1, np.int32)
    seeds = starts[np.argsort(text[starts], kind="stable")]
    per_bucket = np.bincount(text[seeds], minlength=size)
    first_seed = tail - per_bucket
    place = first_seed[text[seeds]] + np.arange(len(seeds)) - (np.cumsum(per_bucket) - per_bucket)[text[seeds]]
    order[place] = seeds
    present = np.flatnonzero(counts)

    filled = head.copy()

    def larger(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if len(before):
            bucket = text[before]
            sort = np.argsort(bucket, kind="stable")
            before, bucket = before[sort], bucket[sort]
            number = np.bincount(bucket, minlength=size)
            order[filled[bucket] + np.arange(len(before)) - (np.cumsum(number) - number)[bucket]] = before
            filled[:] += number

    larger(np.array([n]))
    for c in present:
        done = head[c]
        while done < filled[c]:
            found, done = order[done : filled[c]].copy(), filled[c]
            larger(found)
        if per_bucket[c]:
            larger(order[first_seed[c] : tail[c]].copy())
    room = tail.copy()

    def less(found: np.ndarray) -> None:
        before = found - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            bucket = text[before]
            sort = np.argsort(bucket, kind="stable")
            before, bucket = before[sort], bucket[sort]
            number = np.bincount(bucket, minlength=size)
            order[room[bucket] - 1 - (np.arange(len(before)) - (np.cumsum(number) - number)[bucket])] = before
            room[:] -= number

    for c in present[::-1]:
        done = tail[c]
        while done > room[c]:
            found, done = order[room[c] : done][::-1].copy(), room[c]
            less(found)
        if filled[c] > head[c]:
            less(order[head[c] : filled[c]][::-1].copy())
    return order


def _induce_one_by_one(text: np.ndarray, smaller: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The same for large alphabets with few suffixes in each bucket."""
    n = len(text)
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    chars, is_smaller = text.tolist(), smaller.tolist()
    order = [-1] * n
    tail = ends.tolist()
    for start in starts[::-1].tolist():
        tail[chars[start]] -= 1
        order[tail[chars[start]]] = start
    head = (ends - counts).tolist()
    last = chars[n - 1]
    order[head[last]] = n - 1
    head[last] += 1
    for i in range(n):
        before = order[i] - 1
        if before >= 0 and not is_smaller[before]:
            c = chars[before]
            order[head[c]] = before
            head[c] += 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        before = order[i] - 1
        if before >= 0 and is_smaller[before]:
            c = chars[before]
            tail[c] -= 1
            order[tail[c]] = before
    return np.array(order, np.int32)


def _order_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a text with a large alphabet: names of runs twice as long in each round, until all differ."""
    rank, reach, n = np.unique(names, return_inverse=True)[1].astype(np.int64), 1, len(names)
    while True:
        following = np.zeros(n, np.int64)
        following[: n - reach] = rank[reach:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        reach *= 2


def suffix_array(text: np.ndarray, size: int = 256) -> np.ndarray:
    """Start places of all suffixes in order, by induced sorting.

    Suffixes are classified, the leftmost smaller ones sorted by their substrings; where substrings are equal their names
    form a text of at most half the length. That is sorted in the same way, or by doubling if its alphabet is so large that
    buckets hold a few suffixes only, which array operations could not induce together.
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    text = text.astype(np.int32)
    induce = _induce_by_bucket if n > 64 * size else _induce_one_by_one
    smaller = _types(text)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(starts) > 1:
        by_text = starts[np.argsort(text[starts], kind="stable")]
        order = induce(text, smaller, by_text, size)
        is_start = np.zeros(n, bool)
        is_start[starts] = True
        order = order[is_start[order]]
        # Lengths up to and with the next leftmost smaller suffix; the last one reaches the end and equals no other.
        length = np.zeros(n, np.int64)
        length[starts] = np.append(np.diff(starts) + 1, n + 1)
        a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
        equal = length[a] == length[b]
        open_pairs, offset = np.flatnonzero(equal), 0
        while len(open_pairs):
            open_pairs = open_pairs[length[a[open_pairs]] > offset]
            differ = text[a[open_pairs] + offset] != text[b[open_pairs] + offset]
            equal[open_pairs[differ]] = False
            open_pairs, offset = open_pairs[~differ], offset + 1
        names = np.zeros(n, np.int32)
        names[order] = np.concatenate([[0], np.cumsum(~equal)])
        reduced = names[starts]
        count = int(names[order[-1]]) + 1
        if count == len(starts):
            sorted_starts = order
        else:
            sorted_starts = starts[suffix_array(reduced, count) if len(reduced) > 64 * count or len(reduced) < 2_000 else _order_names(reduced)]
    else:
        sorted_starts = starts
    return induce(text, smaller, sorted_starts, size)


def permuted_lcp(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every place the length of the prefix it shares with the suffix before it in the order.

    A place whose left neighbours agree has one less than the place before it; only the others are compared,
    eight bytes at a time, and the rest is filled from them.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.arange(n)
    follows = (place > 0) & (before > 0)
    follows[follows] = text[place[follows] - 1] == text[before[follows] - 1]
    chosen = place[~follows]
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 8].copy().view("<u8").reshape(-1)
    shared = np.zeros(n, np.int64)
    live = chosen[before[chosen] >= 0]
    while len(live):
        a, b = live + shared[live], before[live] + shared[live]
        room = n - np.maximum(a, b)
        differ = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        low = differ & (~differ + np.uint64(1))
        step = np.where(differ == 0, 8, np.round(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64) // 8)
        step = np.minimum(step, room)
        shared[live] += step
        live = live[(step == 8) & (room > 8)]
    value = np.where(~follows, shared + place, 0)
    last = np.maximum.accumulate(np.where(~follows, place, 0))
    return value[last] - place


def repeated_windows(regions: list[bytes], counts: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """For every region the offsets of its windows that occur twice among all regions (a region counts ``counts`` times)."""
    text = np.frombuffer(b"".join(region + bytes([SEPARATOR]) for region in regions), np.uint8)
    sizes = np.array([len(region) + 1 for region in regions], np.int64)
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(text).astype(np.int64)
    shared = permuted_lcp(text, order)
    region = np.repeat(np.arange(len(regions)), sizes)
    offset = np.arange(len(text)) - starts[region]
    owned = offset + window < sizes[region]
    joins = shared[order] >= window
    joins[0] = False
    run = np.cumsum(~joins) - 1
    mass = np.bincount(run[owned[order]], counts[region[order]][owned[order]], run[-1] + 1) if len(run) else np.zeros(0)
    twice = np.zeros(len(text), bool)
    twice[order] = (mass[run] > 1) & owned[order]
    return [np.flatnonzero(twice[s : s + z]) for s, z in zip(starts.tolist(), sizes.tolist())]


# --- regions


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_STEP = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_STEP, pow(_STEP, -1, 1 << 64))):
            _POWERS[i] = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(2 * n, base, np.uint64))])
    return _POWERS[0][:n], _POWERS[1][:n]


def anchors(data: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Regions of a text: first window, last window and the hash of the gram they belong to."""
    n = len(data)
    if n < window:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.int64),)
    power, inverse = _powers(n + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * power[:n])])
    hashes = mix((total[gram:] - total[: n - gram + 1]) * inverse[: n - gram + 1])
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    width = window - gram + 1
    rows = -(-len(ranked) // width)
    block = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    block[: len(ranked)] = ranked
    block = block.reshape(rows, width)
    forward = np.minimum.accumulate(block, axis=1).reshape(-1)
    backward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    count = n - window + 1
    least = np.minimum(backward[:count], forward[width - 1 : width - 1 + count])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([cut[1:], [count]]) - 1
    return cut, last, hashes[place[cut]].view(np.int64)


def regions_of(text: bytes, segment: int = 1 << 20, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``anchors`` of a text of any length, a segment of windows at a time."""
    data = np.frombuffer(text, np.uint8)
    parts = []
    for low in range(0, max(1, len(data) - window + 1), segment):
        first, last, grams = anchors(data[low : low + segment + window - 1], window, gram)
        parts.append((first + low, last + low, grams))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype("<i4").tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


def read_regions(docs: DataFrame, key: str, text: str, window: int, gram: int) -> DataFrame:
    """Per different text: its digest, number of rows, smallest key, its different regions (gram, digest, times, place, size) and its layout."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["text_id", "key", "grams", "digests", "times", "places", "sizes", "layout"]
        kinds = [pa.string(), None, pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary()]
        for batch in batches:
            rows, kinds[1] = [], batch.schema.types[1]
            for name, own, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                data = (value.as_py() or "").encode("utf-8")
                first, last, grams = regions_of(data, window=window, gram=gram)
                if len(first) == 0:
                    continue
                ends = (last + window).tolist()
                digests = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), ends)]
                known: dict[bytes, int] = {}
                number = np.array([known.setdefault(d, len(known)) for d in digests], np.int64)
                where = np.unique(number, return_index=True)[1]
                layout = _pack(np.stack([first, number]).reshape(-1))
                rows.append((name, own, grams[where], [digests[i] for i in where], np.bincount(number), first[where], (last - first + window)[where], layout))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"text_id string, key {kind}, grams array<bigint>, digests array<binary>, times array<int>, places array<int>, sizes array<int>, layout binary"
    found = docs.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_id"), F.col(key).alias("key"), F.col(text).alias("t")).where(F.octet_length("t") >= window).mapInArrow(apply, schema)
    same = [F.first(name).alias(name) for name in ("grams", "digests", "times", "places", "sizes", "layout")]
    return materialize(found.groupBy("text_id").agg(F.count(F.lit(1)).alias("copies"), F.min("key").alias("key"), *same), "regions")


def _ranges(places: np.ndarray) -> bytes:
    """Sorted offsets as pairs (from, to)."""
    if len(places) == 0:
        return b""
    cut = np.flatnonzero(np.diff(places) != 1)
    return np.stack([places[np.concatenate([[0], cut + 1])], places[np.concatenate([cut, [len(places) - 1]])] + 1], axis=1).astype("<i4").tobytes()


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, max_regions: int | None = None) -> DataFrame:
    """Spans to remove from every different text that has any: text_id (sha256 of its bytes), spans (pairs of 32-bit
    integers, packed), n_removed, n_spans.

    A gram with more than ``max_regions`` different regions is split: its windows are counted by their 128-bit digests
    instead, summed before the shuffle.
    """
    limit = max_regions or MAX_REGIONS
    texts = read_regions(docs, key, text, window, gram)
    zipped = F.arrays_zip("grams", "digests", "times", "places", "sizes")
    uses = texts.select("text_id", "copies", F.posexplode(zipped).alias("number", "r"))
    uses = uses.select("text_id", "copies", "number", F.col("r.grams").alias("gram"), F.col("r.digests").alias("digest"), F.col("r.times").alias("times"), F.col("r.places").alias("place"), F.col("r.sizes").alias("size"))
    one = F.min(F.struct("text_id", "place", "size")).alias("one")
    regions = uses.groupBy("gram", "digest").agg(F.sum(F.col("copies") * F.col("times")).alias("n"), one)
    regions = materialize(regions.select("gram", "digest", "n", "one.*"), "distinct-regions")
    grams = regions.groupBy("gram").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("single")).where("total > 1")
    shared = materialize(regions.join(grams.drop("total"), "gram"), "shared-regions")
    # Where every region of a gram was counted more than once, all its windows are repeated.
    alone = shared.where("single = 0").select("gram", "digest", F.lit(None).cast("binary").alias("ranges"))
    compared = shared.where("single > 0")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                data = value.as_py().encode("utf-8")
                rows = [(w["gram"], w["digest"], w["n"], w["different"], data[w["place"] : w["place"] + w["size"]]) for w in wanted]
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["gram", "digest", "n", "different", "bytes"])

    wanted = compared.groupBy(F.col("text_id").alias("wanted_id")).agg(F.collect_list(F.struct("gram", "digest", "n", "different", "place", "size")).alias("wanted"))
    wanted = wanted.join(texts.select(F.col("text_id").alias("wanted_id"), F.col("key").alias("wanted_key")), "wanted_id")
    rows = docs.select(F.col(key).alias("key"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_id"), F.col(text).alias("t"))
    # Counts already hold the copies of a text: only the row with the smallest key is cut.
    sources = rows.join(wanted, (F.col("text_id") == F.col("wanted_id")) & F.col("key").eqNullSafe(F.col("wanted_key")))
    cut_regions = sources.select("t", "wanted").mapInArrow(cut, "gram bigint, digest binary, n bigint, different bigint, bytes binary")
    cut_regions = materialize(cut_regions, "region-bytes")

    def search(group: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        digests, data = table.column("digest").to_pylist(), table.column("bytes").to_pylist()
        # A text with copies is cut once per copy.
        kept = list({d: i for i, d in enumerate(digests)}.values())
        found = repeated_windows([data[i] for i in kept], table.column("n").to_numpy()[kept], window)
        hits = [(digests[i], _ranges(places)) for i, places in zip(kept, found) if len(places)]
        columns = list(zip(*hits)) if hits else ((), ())
        grams = table.column("gram").to_numpy()
        own = {digests[i]: int(grams[i]) for i in kept}
        return pa.table({"gram": pa.array([own[d] for d in columns[0]], pa.int64()), "digest": pa.array(columns[0], pa.binary()), "ranges": pa.array(columns[1], pa.binary())})

    total = compared.where(F.col("different") <= limit).agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-int(total) // SHARD_BYTES))
    shard = F.pmod(F.xxhash64("gram"), F.lit(shards))
    result = "gram bigint, digest binary, ranges binary"
    found = cut_regions.where(F.col("different") <= limit).groupBy(shard.alias("shard")).applyInArrow(search, result)
    hot = cut_regions.where(F.col("different") > limit).dropDuplicates(["gram", "digest"])
    found = materialize(found.unionByName(_by_window(hot, window, result)).unionByName(alone), "repeats")
    return _spans(texts, uses, found, window)


def _by_window(hot: DataFrame, window: int, result: str) -> DataFrame:
    """Windows of the regions of hot grams that occur twice, by counting digests of windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, digest, n, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                count = len(data) - window + 1
                names = [hashlib.blake2b(data[i : i + window], digest_size=16).digest() for i in range(count)]
                columns = [pa.array([gram] * count, pa.int64()), pa.array([digest] * count, pa.binary()), pa.array([n] * count, pa.int64()), pa.array(range(count), pa.int32()), pa.array(names, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["gram", "digest", "n", "at", "name"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [np.array(sorted(at), np.int64) for at in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([_ranges(p) for p in places], pa.binary())], ["gram", "digest", "ranges"])

    each = hot.select("gram", "digest", "n", "bytes").mapInArrow(windows, "gram bigint, digest binary, n bigint, at int, name binary")
    twice = each.groupBy("name").agg(F.sum("n").alias("n")).where("n > 1").select("name")
    places = each.join(twice, "name", "left_semi").groupBy("gram", "digest").agg(F.collect_list("at").alias("at"))
    return places.mapInArrow(gather, result)


def _spans(texts: DataFrame, uses: DataFrame, found: DataFrame, window: int) -> DataFrame:
    """Put the repeated windows of the regions back into the texts and unite the bytes they cover."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text_id, layout, hits in zip(*(column.to_pylist() for column in batch.columns)):
                first, number = _unpack(layout).reshape(2, -1).astype(np.int64)
                whole = {h["number"]: h for h in hits}
                begin, end = [], []
                for start, k in zip(first.tolist(), number.tolist()):
                    hit = whole.get(k)
                    if hit is None:
                        continue
                    if hit["ranges"] is None:
                        begin.append([start])
                        end.append([start + hit["size"]])
                    else:
                        pairs = np.frombuffer(hit["ranges"], "<i4").reshape(-1, 2)
                        begin.append((pairs[:, 0] + start).tolist())
                        end.append((pairs[:, 1] - 1 + start + window).tolist())
                begin, end = np.concatenate(begin), np.concatenate(end)
                reach = np.maximum.accumulate(end)
                new = np.concatenate([[True], begin[1:] > reach[:-1]])
                low, high = begin[new], reach[np.concatenate([new[1:], [True]])]
                rows.append((text_id, np.stack([low, high], axis=1).astype("<i4").tobytes(), int((high - low).sum()), len(low)))
            if rows:
                kinds = [pa.string(), pa.binary(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["text_id", "spans", "n_removed", "n_spans"])

    hits = uses.select("text_id", "number", "gram", "digest", "size").join(found, ["gram", "digest"])
    per_text = hits.groupBy("text_id").agg(F.collect_list(F.struct("number", "size", "ranges")).alias("hits"))
    joined = texts.select("text_id", "layout").join(per_text, "text_id")
    return materialize(joined.mapInArrow(apply, "text_id string, spans binary, n_removed bigint, n_spans bigint"), "spans")


def cut_out(data: bytes, spans: bytes | None) -> bytes:
    """The bytes outside the spans."""
    if not spans:
        return data
    pairs = np.frombuffer(spans, "<i4").reshape(-1, 2).tolist()
    return b"".join(data[a:b] for a, b in zip([0, *(p[1] for p in pairs)], [*(p[0] for p in pairs), len(data)]))


def _with_spans(docs: DataFrame, key: str, text: str, whole: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """``docs`` with what to cut from each row, in columns whose names begin with ``cut:``."""
    spans = repeated_spans(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), "key", "text", **options)
    if whole is not None:
        texts = docs.select(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_id"), F.col(text).alias("text"))
        spans = spans.join(whole(texts.join(spans.select("text_id"), "text_id", "left_semi")), "text_id", "left_anti")
    spans = spans.select([F.col(name).alias(f"cut:{name}") for name in spans.columns])
    return docs.join(spans, F.sha2(F.coalesce(docs[text], F.lit("")), 256) == spans["cut:text_id"], "left")


def removed_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """What removing every byte of a repeated window leaves of each row: key, n_bytes, n_removed, n_spans, kept_sha256.

    A window is ``window`` bytes of the UTF-8 of one text; it is repeated if the same bytes start anywhere else, in this
    or another row. Null and empty texts, and texts shorter than a window, lose nothing. Repeated rows repeat each other's
    windows. A null key stays null, other columns are ignored, an empty table gives an empty result.
    """
    joined = _with_spans(docs.select(F.col(key).alias("key"), F.col(text).alias("t")), "key", "t", **options)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, spans, same, *numbers = batch.columns
            kept = [hashlib.sha256(cut_out(value.as_py().encode("utf-8"), s)).hexdigest() if s else untouched for value, s, untouched in zip(texts, spans.to_pylist(), same.to_pylist())]
            yield pa.RecordBatch.from_arrays([names, *numbers, pa.array(kept, pa.string())], [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    zero = lambda name: F.coalesce(F.col(f"cut:{name}"), F.lit(0)).cast("bigint").alias(name)
    # Only texts that lose something travel to the digest.
    lost = F.when(F.col("cut:spans").isNotNull(), F.col("t"))
    digest = F.sha2(F.coalesce("t", F.lit("")), 256)
    size = F.coalesce(F.octet_length("t"), F.lit(0)).cast("bigint").alias("n_bytes")
    rows = joined.select("key", lost.alias("t"), "cut:spans", digest.alias("same"), size, zero("n_removed"), zero("n_spans"))
    return rows.mapInArrow(apply, f"`{key}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; characters that a cut would split go with it. Rows all stay.

    ``whole`` is given the texts that would lose bytes (text_id, text) and returns the text_id of those that are left as they are.
    """
    joined = _with_spans(docs, key, text, **options)
    columns = docs.columns
    others = [c for c in columns if c != text]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column(len(others)), batch.column(len(others) + 1).to_pylist()
            kept = [cut_out(value.as_py().encode("utf-8"), s).decode("utf-8", "ignore") if s else value.as_py() for value, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(kept, pa.string())], [*others, text])

    schema = docs.select(*others, text).schema
    rows = joined.select(*(docs[c] for c in others), docs[text], "cut:spans")
    return rows.mapInArrow(apply, schema).select(*columns)
