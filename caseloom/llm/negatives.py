"""Hard negatives by exact integer products: subset-sum tables of anchors, looked up with packed bit planes of candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import materialize

# Dimensions that share a table: one byte of a bit plane addresses the sum of any subset of them.
GROUP = 8
# Anchors whose tables are built together; sets the memory of a cell: dim / 8 * 256 sums each.
TILE = 128
HELD = 2**63 - 1
# Stands for no score in the padded bands of an anchor.
NO_BAND = -HELD - 1


def whole_components(column: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors of one length as rows of integers; beyond 64 bits as Python's integers."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    shape = (len(column), len(flat) // max(1, len(column)))
    if np.abs(flat).max(initial=0) < 2.0**62:
        return flat.astype(np.int64).reshape(shape)
    return np.array([int(x) for x in flat], dtype=object).reshape(shape)


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """The two's complement bits of rows of integers as bytes [plane, group of eight dimensions, row], lowest plane first.

    The last plane is the sign. A byte holds one bit of each dimension of its group, the first dimension in its lowest bit.
    """
    rows, dim = vectors.shape
    low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
    planes = max(low.bit_length() if low >= 0 else (-low - 1).bit_length(), max(high, 0).bit_length()) + 1
    padded = np.zeros((rows, -(-dim // GROUP) * GROUP), vectors.dtype)
    padded[:, :dim] = vectors
    bits = np.stack([((padded >> j) & 1).astype(np.uint8) for j in range(planes)])
    packed = np.packbits(bits, axis=2, bitorder="little")
    return np.ascontiguousarray(packed.transpose(0, 2, 1))


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """Sums of every subset of each group of eight dimensions: [group, subset, anchor], built by doubling."""
    count, dim = anchors.shape
    groups = -(-dim // GROUP)
    padded = np.zeros((count, groups * GROUP), kind)
    padded[:, :dim] = anchors
    parts = padded.reshape(count, groups, GROUP).transpose(1, 2, 0)
    table = np.zeros((groups, 1, count), kind)
    for d in range(GROUP):
        table = np.concatenate((table, table + parts[:, d : d + 1, :]), axis=1)
    return table


def exact_scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Integer inner products [candidate, anchor]: planes from the sign down, shifted by one and added to the sums they address.

    Sums are kept in 32 bits if no score nor any sum on the way can leave them, else in 64, else as Python's integers.
    """
    reach = float(np.abs(anchors.astype(np.float64)).sum(axis=1).max(initial=0)) * 1.001 * 2.0 ** len(planes)
    kind = np.int32 if reach < 2**31 else np.int64 if reach < 2**62 else object
    table = subset_sums(anchors, kind)
    total = np.zeros((planes.shape[2], len(anchors)), kind)
    for j in range(len(planes) - 1, -1, -1):
        total += total
        for g in range(planes.shape[1]):
            found = table[g][planes[j, g]]
            total = total - found if j == len(planes) - 1 else np.add(total, found, out=total)
    return total


FIELDS = ("ids", "marks", "labels", "data", "bands")


def _narrow(values: np.ndarray) -> tuple[bytes, str]:
    """Integers in the narrowest type that holds them; beyond 64 bits as text."""
    if values.dtype == object:
        return "\n".join(map(str, values.ravel())).encode(), "text"
    for kind in ("<i2", "<i4"):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind).tobytes(), kind
    return values.astype("<i8").tobytes(), "<i8"


def _packed(rows: DataFrame, keys: list[str], name: str, scale: int, width: int) -> DataFrame:
    """The rows of one ``keys`` (dim, dealt block and what else names a cell's side) as one row, in order of (id, mark).

    Candidates (name "c") become bit planes, anchors keep their components; ``width`` scores of an anchor's bands go along.
    """
    columns = [*(f"{name}_{f}" for f in FIELDS), f"{name}_kind"]
    schema = pa.schema([(k, pa.int32() if k == "dim" else pa.int64()) for k in keys] + [(c, pa.binary()) for c in columns[:-1]] + [(columns[-1], pa.string())])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids, marks, labels = (table.column(c).to_numpy().astype("<i8") for c in ("id", "mark", "label"))
        order = np.lexsort((marks, ids))
        data = whole_components(table.column("vector").chunk(0), scale)[order]
        bands = b""
        if width:
            padded = np.full((len(ids), width), NO_BAND, "<i8")
            for i, scores in enumerate(table.column("bands").to_pylist()):
                padded[i, : len(scores)] = scores
            bands = padded[order].tobytes()
        if name == "c":
            planes = bit_planes(data)
            body, kind = planes.tobytes(), str(len(planes))
        else:
            body, kind = _narrow(data)
        values = [*(k.as_py() for k in key), ids[order].tobytes(), marks[order].tobytes(), labels[order].tobytes(), body, bands, kind]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    kinds = [*(f"{k} {'int' if k == 'dim' else 'bigint'}" for k in keys), *(f"{c} binary" for c in columns[:-1]), f"{columns[-1]} string"]
    return rows.groupBy(*keys).applyInArrow(pack, ", ".join(kinds))


def _spread(column: str) -> Column:
    """A row for each of the other side's blocks."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.col(column) - 1))


def _meet(anchors: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Every block of anchors with every block of candidates.

    Merged: Spark takes a side for as large as the table it was packed from, though it stands there once for each of the other
    side's blocks, and would send it whole through the driver.
    """
    spread = anchors.withColumn("c", _spread("n_c")).drop("n_c").hint("merge")
    return spread.join(candidates.withColumn("a", _spread("n_a")).drop("n_a"), keys)


class _Cell:
    """One block of anchors against one block of candidates."""

    def __init__(self, row: dict):
        dim = row["dim"]
        self.own, self.own_marks, self.own_labels = (np.frombuffer(row[f"a_{f}"], "<i8") for f in FIELDS[:3])
        self.ids, self.marks, self.labels = (np.frombuffer(row[f"c_{f}"], "<i8") for f in FIELDS[:3])
        self.bands = np.frombuffer(row["a_bands"], "<i8").reshape(len(self.own), -1)
        if row["a_kind"] == "text":
            anchors = np.array([int(x) for x in row["a_data"].split(b"\n")], dtype=object)
        else:
            anchors = np.frombuffer(row["a_data"], row["a_kind"]).astype(np.int64)
        self.anchors = anchors.reshape(len(self.own), dim)
        self.planes = np.frombuffer(row["c_data"], np.uint8).reshape(int(row["c_kind"]), -(-dim // GROUP), len(self.ids))

    def tiles(self) -> Iterator[tuple[int, np.ndarray]]:
        """(place of the first anchor, scores [anchor, candidate])."""
        for at in range(0, len(self.own), TILE):
            yield at, np.ascontiguousarray(exact_scores(self.anchors[at : at + TILE], self.planes).T)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[_Cell]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield _Cell(batch.slice(i, 1).to_pylist()[0])


def _batch(found: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names)


def _first(scores: np.ndarray, chosen: np.ndarray, k: int) -> list[int]:
    """Places of the k highest scores among ``chosen`` (ascending places, which are in order of ids); earlier places win ties."""
    if len(chosen) > 4 * k and scores.dtype != object:
        chosen = chosen[scores[chosen] >= np.partition(scores[chosen], -k)[-k]]
    return sorted(chosen.tolist(), key=lambda c: (-int(scores[c]), c))[:k]


def _held(score) -> int:
    return max(-HELD - 1, min(HELD, int(score)))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, id: str = "vec_id",
                   vector: str = "embedding", label: str = "label", scale: int = 256, anchor_block: int = 1024, candidate_block: int = 4096) -> DataFrame:
    """For each anchor its best rows of the same label, and for each of these the best rows of other labels in a score band.

    Components become floor(scale * x); a score is the integer inner product, higher scores first, ties by smaller id. The
    positives of an anchor are its first ``positives`` other rows of the same label, the negatives of a positive the first
    ``negatives`` rows of different labels with low * positive_score <= 100 * negative_score <= high * positive_score.

    Scores are exact and complete: a table holds the sum of every subset of eight dimensions of an anchor, the packed bits of
    the candidates address it, plane by plane. Anchors and candidates are dealt into blocks by hash and meet in cells;
    positives only meet blocks of their own label. A cell returns at most ``positives`` (then ``negatives``) rows for an
    anchor (an anchor and a positive), and a ranked window that keeps so many before its shuffle merges the cells.
    Work grows with anchors times rows, memory with a block; no label, however frequent, lands in one task.

    Rows with a null id, label or vector or with a null or non-finite component take no part. An empty vector scores 0.
    Vectors of another length than the anchor's are no candidates for it. An anchor never meets rows of its own id. Rows
    repeated exactly (id, label and vector) count once; rows of one id with different labels or vectors are separate
    candidates and anchors. Other columns are ignored, an empty table gives an empty result. Scores outside the range of
    long are compared exactly in their cell and held at its ends, their bands too.
    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank and the marks (hashes of
    label and vector) of anchor, positive and negative.
    """

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
        rows = rows.withColumn("dim", F.size("vector")).withColumn("mark", F.xxhash64("label", "vector"))
        return rows.dropDuplicates(["id", "mark"])

    def counted(rows: DataFrame, block: int, name: str) -> DataFrame:
        return rows.groupBy("dim", "label").agg(F.ceil(F.count("*") / block).alias(name))

    def dealt(rows: DataFrame, name: str, blocks: Column) -> DataFrame:
        return rows.withColumn(name, F.pmod(F.xxhash64("id", "mark"), blocks))

    rows, asking = materialize(usable(vectors), "rows"), materialize(usable(anchors), "anchors")

    # Positives: the cells of a label are the pairs of its blocks of anchors and its blocks of rows.
    sizes = counted(asking, anchor_block, "n_a").join(counted(rows, candidate_block, "n_c"), ["dim", "label"])
    left = _packed(dealt(asking.join(sizes, ["dim", "label"]), "a", F.col("n_a")), ["dim", "label", "a", "n_c"], "a", scale, 0)
    right = _packed(dealt(rows.join(sizes, ["dim", "label"]), "c", F.col("n_c")), ["dim", "label", "c", "n_a"], "c", scale, 0)
    cells = _meet(left, right, ["dim", "label", "a", "c"])

    def best_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            found = []
            for at, scores in cell.tiles():
                for i, line in enumerate(scores, at):
                    others = np.flatnonzero(cell.ids != cell.own[i])
                    found += [(cell.own[i], cell.own_marks[i], cell.ids[c], cell.marks[c], _held(line[c])) for c in _first(line, others, positives)]
            if found:
                yield _batch(found, ["anchor_id", "anchor_mark", "positive_id", "positive_mark", "positive_score"])

    found = cells.mapInArrow(best_positives, "anchor_id bigint, anchor_mark bigint, positive_id bigint, positive_mark bigint, positive_score bigint")
    order = Window.partitionBy("anchor_id", "anchor_mark").orderBy(F.desc("positive_score"), "positive_id", "positive_mark")
    chosen = materialize(found.withColumn("positive_rank", F.row_number().over(order).cast("long")).where(F.col("positive_rank") <= positives), "positives")

    # Negatives: anchors with the scores of their positives against the blocks of all rows.
    bands = chosen.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_mark").alias("mark")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("positive_rank", "positive_score"))), lambda x: x["positive_score"]).alias("bands"))
    n_a = F.lit(max(1, math.ceil(asking.count() / anchor_block))).cast("long")
    n_c = F.lit(max(1, math.ceil(rows.count() / candidate_block))).cast("long")
    left = _packed(dealt(asking.join(bands, ["id", "mark"]), "a", n_a), ["dim", "a"], "a", scale, positives).withColumn("n_c", n_c)
    right = _packed(dealt(rows, "c", n_c), ["dim", "c"], "c", scale, 0).withColumn("n_a", n_a)
    cells = _meet(left, right, ["dim", "a", "c"])

    def best_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            found = []
            for at, scores in cell.tiles():
                for i, line in enumerate(scores, at):
                    others = np.flatnonzero((cell.labels != cell.own_labels[i]) & (cell.ids != cell.own[i]))
                    for rank, score in enumerate(cell.bands[i].tolist(), 1):
                        least, most = -(-low * score // 100), high * score // 100
                        if score == NO_BAND or least > most:
                            continue
                        inside = others[(line[others] >= least) & (line[others] <= most)]
                        found += [(cell.own[i], cell.own_marks[i], rank, cell.ids[c], cell.marks[c], _held(line[c])) for c in _first(line, inside, negatives)]
            if found:
                yield _batch(found, ["anchor_id", "anchor_mark", "positive_rank", "negative_id", "negative_mark", "negative_score"])

    mined = cells.mapInArrow(best_negatives, "anchor_id bigint, anchor_mark bigint, positive_rank bigint, negative_id bigint, negative_mark bigint, negative_score bigint")
    order = Window.partitionBy("anchor_id", "anchor_mark", "positive_rank").orderBy(F.desc("negative_score"), "negative_id", "negative_mark")
    ranked = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor_id", "anchor_mark", "positive_rank"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score",
        F.col("positive_rank").cast("int").alias("positive_rank"), "anchor_mark", "positive_mark", "negative_mark")
