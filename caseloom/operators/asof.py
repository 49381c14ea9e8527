"""As-of joins of irregular times without a task for a whole key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from caseloom.session import materialize


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, right_ts: str | None = None, ties: Sequence[str] = (), prefix: str = "right_") -> DataFrame:
    """Every row of ``left`` with the latest row of ``right`` of the same keys that is not later, or nulls.

    Both sides are sorted together by ranges of (keys, time), so rows of one key spread over as many tasks as its size asks
    for. A task carries the last right row forward; what was last in a task goes to the rows that open the next one, through a
    scan over one row per task. Of right rows with equal keys and times the last by ``ties``, then by a hash of the row,
    counts. Keys compare null-safe. Left rows without time find nothing, right rows without time are left out.
    Returns the columns of ``left`` and those of ``right`` but its keys, each with ``prefix``.
    """
    right_ts = right_ts or ts
    values = [c for c in right.columns if c not in keys]
    kinds = {f.name: f.dataType for f in right.schema}
    own = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    found = F.struct(*[F.col(f"`{c}`") for c in values])
    key = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    asking = left.select(key.alias("key"), F.col(f"`{ts}`").alias("ts"), F.lit(1).alias("side"), F.lit(None).cast(right.select(found.alias("f")).schema[0].dataType).alias("found"), own.alias("own"))
    order = [*[F.col(f"`{c}`") for c in ties], F.xxhash64(*[F.col(f"`{c}`") for c in values])]
    giving = right.where(F.col(f"`{right_ts}`").isNotNull()).select(
        key.alias("key"), F.col(f"`{right_ts}`").cast(left.schema[ts].dataType).alias("ts"), F.lit(0).alias("side"), found.alias("found"),
        F.lit(None).cast(left.select(own.alias("o")).schema[0].dataType).alias("own"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("order"))
    asking = asking.withColumn("order", F.lit(None).cast(giving.schema["order"].dataType))
    # The key's text tells keys apart in a task; nulls are part of it.
    both = asking.unionByName(giving).withColumn("name", F.to_json("key", {"ignoreNullFields": "false"}))
    # Left rows without time stand first in their key and find nothing.
    by = ["name", F.col("ts").asc_nulls_first(), "side", "order", F.xxhash64("own")]
    ordered = both.repartitionByRange(*by).sortWithinPartitions(*by).select("name", "ts", "side", "found", "own")
    schema = ordered.select("name", "found", "own").schema
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    fields = to_arrow_schema(schema)

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Left rows with what was last in this task (``open``: nothing was yet in the row's key), then the task's own last row."""
        part = TaskContext.get().partitionId()
        last_name, last_found, first_name, seen = None, None, None, False
        out = pa.schema([("part", pa.int32()), ("kind", pa.int32()), *[fields.field(i) for i in range(3)]])
        for batch in batches:
            if not batch.num_rows:
                continue
            name = batch.column("name")
            side = batch.column("side").to_numpy()
            timed = batch.column("ts").is_valid().to_numpy(zero_copy_only=False)
            codes = name.dictionary_encode().indices.to_numpy()
            heads = np.concatenate(([True], codes[1:] != codes[:-1]))
            if not seen:
                first_name, seen = name[0].as_py(), True
            elif name[0].as_py() == last_name:
                heads[0] = False
            else:
                last_found = None
            at = np.arange(batch.num_rows)
            given = np.maximum.accumulate(np.where(side == 0, at, -1))
            start = np.maximum.accumulate(np.where(heads, at, -1))
            # Within the batch, else from the batches before (place of the carried row), else nothing yet.
            source = np.where(given >= np.maximum(start, 0), given, -1)
            pool, carried = batch.column("found"), len(batch)
            if last_found is not None:
                pool = pa.concat_arrays([pool, last_found])
                source = np.where((source < 0) & (start < 0), carried, source)
            mine = np.flatnonzero(side == 1)
            chosen = np.where(timed[mine], source[mine], -1)
            none = chosen < 0
            index = pa.array(np.where(none, 0, chosen), mask=none)
            opening = np.asarray([x == first_name for x in name.take(pa.array(mine)).to_pylist()], bool) & none & timed[mine] if len(mine) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(mine), part, np.int32)), pa.array(opening.astype(np.int32)), name.take(pa.array(mine)), pool.take(index), batch.column("own").take(pa.array(mine))], schema=out)
            last_name = name[-1].as_py()
            if source[-1] >= 0:
                last_found = pool.slice(int(source[-1]), 1)
            elif heads.any():
                last_found = None
        if seen:
            # kind 2: the last row was found here; 3: none, and the last key is not the first; 4: none in a task of one key.
            state = 2 if last_found is not None else 3 if last_name != first_name else 4
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([state], pa.int32()), pa.array([last_name], fields.field(0).type), last_found if last_found is not None else pa.nulls(1, fields.field(1).type), pa.nulls(1, fields.field(2).type)], schema=out)

    rows = materialize(ordered.mapInArrow(carry, f"part int, kind int, {kind}"), "asof")
    ends = rows.where("kind >= 2").select("part", "kind", "name", "found").orderBy("part").collect()
    spark, incoming, current = left.sparkSession, [], None
    for row in ends:
        if current is not None:
            incoming.append((row["part"], *current))
        if row["kind"] == 2:
            current = (row["name"], row["found"])
        elif row["kind"] == 3 or (current is not None and current[0] != row["name"]):
            current = None
    carried = spark.createDataFrame(incoming, rows.select(F.col("part").alias("to"), F.col("name").alias("of"), F.col("found").alias("before")).schema)
    same = (F.col("kind") == 1) & (F.col("part") == F.col("to")) & (F.col("name") == F.col("of"))
    # One row per task.
    joined = rows.where("kind < 2").join(F.broadcast(carried), same, "left")
    chosen = F.when(F.col("kind") == 1, F.col("before")).otherwise(F.col("found"))
    result = joined.select("own", chosen.alias("found"))
    return result.select(*[F.col(f"own.`{c}`").alias(c) for c in left.columns], *[F.col(f"found.`{c}`").cast(kinds[c]).alias(f"{prefix}{c}") for c in values])
