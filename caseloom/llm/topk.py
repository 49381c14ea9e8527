"""Exact top-k search by inner product: branch and bound over blocks of dimensions in vertical layout."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LONG = 2**63 - 1


def integer_matrix(column: pa.ListArray, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors of one length, as rows of 64-bit integers (held at the ends of that range)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    scaled = np.floor(flat * scale)
    whole = np.clip(scaled, -9.2e18, 9.2e18).astype(np.int64)
    return whole.reshape(len(column), -1)


def remaining_norms(vertical: np.ndarray, edges: list[int]) -> np.ndarray:
    """Euclidean norms of what is left of each vector after each edge, a little too large rather than too small."""
    squares = np.square(vertical.astype(np.float64))
    tails = [np.sqrt(squares[edge:].sum(axis=0)) * (1 + 1e-9) for edge in edges]
    return np.stack(tails)


def inner(query: np.ndarray, vertical: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles while they are exact there, else in Python's integers."""
    bound = float(np.abs(query.astype(np.float64)).max(initial=0)) * float(np.abs(vertical.astype(np.float64)).max(initial=0)) * len(query)
    if bound < 2**53:
        return query.astype(np.float64) @ vertical.astype(np.float64)
    return query.astype(object) @ vertical.astype(object)


def best_of_block(query: np.ndarray, own: int, ids: np.ndarray, vertical: np.ndarray, norms: np.ndarray, edges: list[int], k: int) -> list[tuple[int, int]]:
    """The k best (score, id) of one block of candidates for one query.

    Scores grow one block of dimensions at a time. What is still missing is at most the product of the
    remaining norms. Once a candidate's score plus that bound is below the k-th best score minus its bound,
    it cannot be among the k best and its column is left out from then on.
    """
    alive = np.flatnonzero(ids != own)
    tails = remaining_norms(query[:, None], edges)[:, 0]
    score = np.zeros(len(alive))
    for step, (low, high) in enumerate(zip(edges, edges[1:])):
        part = vertical[low:high] if len(alive) == len(ids) else vertical[low:high, alive]
        score = score + inner(query[low:high], part)
        if high < edges[-1] and len(alive) > k:
            missing = tails[step + 1] * norms[step + 1, alive]
            exact = score.astype(np.float64)
            slack = 1e-9 * np.abs(exact).max(initial=0)
            floor = np.partition(exact - missing, -k)[-k] - slack
            keep = exact + missing >= floor
            if keep.sum() < 0.9 * len(alive):
                alive, score = alive[keep], score[keep]
    if len(alive) > k and score.dtype != object:
        keep = score >= np.partition(score, -k)[-k]
        alive, score = alive[keep], score[keep]
    found = sorted((-int(s), int(ids[i])) for s, i in zip(score, alive))[:k]
    return [(max(-LONG - 1, min(LONG, -s)), i) for s, i in found]


def _packer(scale: int, names: list[str]):
    """Turns the rows of a group into one row: ids, keys and the components in vertical layout (a dimension after the other)."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        vectors = integer_matrix(table.column("vector").chunk(0), scale) if table.num_rows else np.zeros((0, 0), np.int64)
        ids = table.column("id").to_numpy().astype("<i8")
        marks = table.column("mark").to_numpy().astype("<i8")
        order = np.lexsort((marks, ids))
        data = np.ascontiguousarray(vectors[order].T).astype("<i8")
        for width in ("<i2", "<i4"):
            if data.size == 0 or (data.min() >= np.iinfo(width).min and data.max() <= np.iinfo(width).max):
                data = data.astype(width)
                break
        values = [key[0].as_py(), key[1].as_py(), ids[order].tobytes(), marks[order].tobytes(), data.tobytes(), data.dtype.str]
        kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.string()]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names)

    return pack


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256,
                step: int = 16, query_block: int = 1024, candidate_block: int = 8192) -> DataFrame:
    """For every row of ``queries`` the ``k`` rows of ``vectors`` with the highest integer inner product.

    Components become floor(scale * x). Both sides are dealt into blocks by hash; every pair of a query block
    and a candidate block is one cell, searched by branch and bound. Cells return at most k rows per query, and
    a ranked window that keeps k rows before its shuffle merges them.

    Ties go to the smaller id. A query never meets candidates of its own id. Vectors that are null, empty or hold
    null or non-finite components, and rows without id, take no part; vectors of another length than the query's
    are no candidates for it. Rows repeated exactly count once; rows of one id with different vectors are
    separate candidates and queries. Other columns are ignored, an empty table gives an empty result. Scores
    outside the range of long are held at its ends.
    Returns query_id, rank, vec_id, score and query_mark (a hash that tells queries of one id apart).
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        rows = rows.where(F.col("id").isNotNull() & (F.size("vector") > 0) & finite)
        return rows.select("id", "vector", F.size("vector").alias("dim"), F.xxhash64("vector").alias("mark")).dropDuplicates(["id", "mark"])

    def blocks(df: DataFrame, name: str, count: int) -> DataFrame:
        names = ["dim", name, f"{name}_ids", f"{name}_marks", f"{name}_data", f"{name}_type"]
        schema = f"dim int, {name} bigint, {name}_ids binary, {name}_marks binary, {name}_data binary, {name}_type string"
        dealt = df.withColumn(name, F.pmod(F.xxhash64("id", "mark"), F.lit(count)))
        return dealt.groupBy("dim", name).applyInArrow(_packer(scale, names), schema)

    n_queries = max(1, math.ceil(queries.count() / query_block))
    n_candidates = max(1, math.ceil(vectors.count() / candidate_block))
    left = blocks(usable(queries), "q", n_queries).withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_candidates - 1).cast("long"))))
    right = blocks(usable(vectors), "c", n_candidates).withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_queries - 1).cast("long"))))
    cells = left.join(right, ["dim", "q", "c"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, own = np.frombuffer(row["c_ids"], "<i8"), np.frombuffer(row["q_ids"], "<i8")
                marks = np.frombuffer(row["q_marks"], "<i8")
                vertical = np.frombuffer(row["c_data"], row["c_type"]).reshape(row["dim"], -1)
                wanted = np.frombuffer(row["q_data"], row["q_type"]).reshape(row["dim"], -1)
                edges = [*range(0, row["dim"], step), row["dim"]]
                norms = remaining_norms(vertical, edges)
                exact = vertical.astype(np.float64) if vertical.dtype.itemsize <= 4 else vertical
                found = []
                for i in range(len(own)):
                    best = best_of_block(wanted[:, i], own[i], ids, exact, norms, edges, k)
                    found += [(int(own[i]), int(marks[i]), c, s) for s, c in best]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["query_id", "query_mark", "vec_id", "score"])

    found = cells.mapInArrow(search, "query_id bigint, query_mark bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query_mark")
