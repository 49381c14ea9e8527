"""Join of near-duplicate texts by the Jaccard similarity of their word shingles, through a forest of MinHash tries.

A text's signature is cut into one label per tree. The labels of a tree, sorted, are a trie; texts that share a prefix meet
in its node. The prefix is shortened from the whole label until every pair at the threshold meets in some tree with
the target probability, and every pair that meets is verified on the shingles themselves. Texts with equal
shingle sets are one class: only one of them is looked up, and their number is counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.graph import components
from caseloom.llm.text import multipliers, shingles, word_hashes
from caseloom.session import materialize

TREES, DEPTH = 10, 6
# A block of members that one task verifies; nodes with more are verified block against block.
BLOCK_MEMBERS, BLOCK_SHINGLES = 4_096, 4_000_000


def signature(found: np.ndarray, chunk: int = 4_096) -> np.ndarray:
    """TREES * DEPTH minima of the shingles under different multipliers, upper 32 bits."""
    factors = multipliers(77, TREES * DEPTH)
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(found), chunk):
        least = np.minimum(least, (found[low : low + chunk, None] * factors).min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def recall(depth: int, threshold: float, trees: int = TREES) -> float:
    """Probability that a pair of that similarity shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - threshold**depth) ** trees


def prefix_depth(threshold: float, target: float) -> int:
    """Shorten the prefix from the whole label until the recall at the threshold reaches the target."""
    depth = DEPTH
    while depth > 1 and recall(depth, threshold) < target:
        depth -= 1
    return depth


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def sign(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per row: key, mark (hash of the text), node (digest of its shingle set, null without words), n_shingles, signature. Written once."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(2):
                found = shingles(word_hashes(value.as_py()), size)
                rows.append((_digest(found), len(found), signature(found).tobytes()) if len(found) else (None, 0, None))
            node, n, sig = zip(*rows) if rows else ((), (), ())
            columns = [batch.column(0), batch.column(1), pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "mark", "node", "n_shingles", "signature"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("t"))
    return materialize(rows.mapInArrow(apply, f"key {kind}, mark bigint, node binary, n_shingles bigint, signature binary"), "signatures")


def shingle_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Shingles of the wanted nodes (node, key, mark of one of their rows), read from the texts again: node, shingles."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(word_hashes(value.as_py()), size).tobytes() for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["node", "shingles"])

    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("m"), F.col(text).alias("t"))
    texts = rows.join(wanted, F.col("k").eqNullSafe(F.col("key")) & (F.col("m") == F.col("mark"))).select("node", "t")
    return texts.mapInArrow(apply, "node binary, shingles binary").dropDuplicates(["node"])


def similar(left: list[np.ndarray], threshold: float, first: np.ndarray, side: np.ndarray | None, tree: int) -> np.ndarray:
    """Matrix of the pairs of a block that reach the threshold and meet in no earlier tree.

    Shared shingles are counted by multiplying incidence matrices, some columns at a time. ``first`` holds a number per
    member and tree that is equal where prefixes are. With ``side`` only pairs of different sides count.
    """
    m, sizes = len(left), np.array([len(x) for x in left])
    _, column, seen = np.unique(np.concatenate(left), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    shared = seen[column] > 1
    row, column = row[shared], column[shared]
    names, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((m, m), np.float32)
    step = max(64, min(4_096, (1 << 24) // max(1, m)))
    for low in range(0, len(names), step):
        a, b = np.searchsorted(column, [low, low + step])
        part = np.zeros((m, min(step, len(names) - low)), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        common += part @ part.T
    found = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-4
    np.fill_diagonal(found, False)
    if side is not None:
        found &= side[:, None] != side[None, :]
    for earlier in range(tree):
        found &= first[:, None, earlier] != first[None, :, earlier]
    return found


def roots(found: np.ndarray) -> np.ndarray:
    """The smallest member that each member is connected with in a matrix of links."""
    label = np.arange(len(found))
    while True:
        best = np.minimum(label, np.where(found, label[None, :], len(found)).min(axis=1, initial=len(found)))
        best = np.minimum(best, best[best])
        if (best == label).all():
            return label
        label = best


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, threshold: float = 0.8, target: float = 0.999) -> DataFrame:
    """One row per row of ``docs``: key, class_id, n_links, n_equal, mark, is_first.

    Words are compared in lower case without marks at their edges; shingles are ``size`` words in a row (a shorter text
    with words is one shingle). ``n_links`` counts the other rows whose similarity is at least ``threshold``, ``n_equal`` the
    rows with the same shingle set (itself included). Rows linked directly or over others form a class, named by
    its smallest key; one row of a class (smallest key, then mark; nulls last) has is_first.

    Pairs are never listed: nodes are verified as matrices, which give counts and one link per member. A node that is too
    large for a task is cut into blocks and every two blocks are compared, so nothing is left out. Null and
    empty texts and texts without words are classes of their own without links. Repeated rows are equal rows; a
    null key is never a class name unless all keys of the class are null. Other columns are ignored, an empty table
    gives an empty result.
    """
    depth = prefix_depth(threshold, target)
    signed = sign(docs, key, text, size)
    one = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "mark"))
    reps = signed.where("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("n_equal"), one.alias("one"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n_shingles"))
    reps = materialize(reps.select("node", "n_equal", F.col("one.key").alias("key"), F.col("one.mark").alias("mark"), "signature", "n_shingles"), "classes")
    # The prefix tries: a row per tree, with the node of the trie that the label's prefix leads to.
    prefix = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("tree"), F.substring("signature", t * (4 * DEPTH) + 1, F.lit(4 * depth)).alias("prefix")))
    rows = reps.select("node", "n_shingles", F.explode(prefix).alias("at")).select("node", "n_shingles", "at.*")
    weight = [F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("weight"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("f"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("g")]
    tries = rows.groupBy("tree", "prefix").agg(*weight).where("n > 1")
    # Nodes of several trees with the same members are verified once, in the first of these trees.
    tries = tries.groupBy("n", "f", "g").agg(F.min(F.struct("tree", "prefix")).alias("at"), F.first("weight").alias("weight")).select("n", "weight", "at.*")
    members = materialize(rows.join(tries, ["tree", "prefix"]).select("tree", "prefix", "node", "n", "weight"), "members")
    wanted = reps.join(members.select("node").distinct(), "node", "left_semi").select("node", "key", "mark")
    sets = shingle_sets(docs, wanted, key, text, size).join(reps.select("node", "signature", "n_equal"), "node")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES))
    dealt = members.select("tree", "prefix", "node", blocks.alias("blocks")).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    shipped = dealt.select("tree", "prefix", "low", "high", "block", "node").join(sets, "node")

    def verify(group: tuple, table: pa.Table) -> pa.Table:
        tree, low, high = group[0].as_py(), group[2].as_py(), group[3].as_py()
        table = table.combine_chunks()
        node = table.column("node").to_pylist()
        left = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
        labels = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u4").reshape(len(node), TREES, DEPTH)[:, :, :depth]
        numbers = [np.unique(labels[:, t], axis=0, return_inverse=True)[1].reshape(-1) for t in range(tree)]
        first = np.stack(numbers, axis=1) if numbers else np.zeros((len(node), 0), np.int64)
        side = None if low == high else table.column("block").to_numpy()
        found = similar(left, threshold, first, side, tree)
        links = found @ table.column("n_equal").to_numpy().astype(np.float64)
        root, linked = roots(found), np.flatnonzero(found.any(axis=1))
        kinds = [pa.binary(), pa.int64(), pa.binary()]
        columns = [[node[i] for i in linked], links[linked].astype(np.int64), [node[root[i]] for i in linked]]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["node", "links", "root"])

    verified = materialize(shipped.groupBy("tree", "prefix", "low", "high").applyInArrow(verify, "node binary, links bigint, root binary"), "links")
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    classes = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    per_node = reps.select("node", "n_equal", "key", "mark").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node")).join(links, "node", "left")
    per_node = materialize(per_node, "nodes")
    heads = per_node.groupBy("root").agg(one.alias("one"))
    named = per_node.join(heads, "root").select("node", F.col("one.key").alias("class_id"), F.col("one.mark").alias("class_mark"), "n_equal", (F.col("n_equal") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    joined = signed.select("key", "mark", "node").join(named, "node", "left")
    alone = F.col("class_mark").isNull()
    return joined.select(
        F.col("key").alias(key), F.when(alone, F.col("key")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("n_equal", F.lit(1)).cast("bigint").alias("n_equal"), "mark",
        (alone | (F.col("key").eqNullSafe(F.col("class_id")) & (F.col("mark") == F.col("class_mark")))).alias("is_first"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One whole row of every class of near duplicates; rows without words all stay, exact repetitions of the row kept go too."""
    found = materialize(near_duplicates(docs, key, text, **options).select(F.col(key).alias("found_key"), F.col("mark").alias("found_mark"), "is_first", "n_equal"), "kept")
    pairs = lambda rows: docs[key].eqNullSafe(rows["found_key"]) & (F.xxhash64(docs[text]) == rows["found_mark"])
    dropped = found.where("not is_first").select("found_key", "found_mark").distinct()
    kept = docs.join(dropped, pairs(dropped), "left_anti")
    # Rows without words have n_equal 1, also where they repeat; equal rows with words count each other.
    repeated = found.where("is_first and n_equal > 1").groupBy("found_key", "found_mark").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, pairs(repeated), "left_semi").dropDuplicates([key, text])
    return kept.join(repeated, pairs(repeated), "left_anti").unionByName(once)
