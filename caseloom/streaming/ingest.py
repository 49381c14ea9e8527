"""Incremental ingest: tail a source until it is drained and upsert every micro-batch."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from caseloom.operators.relational import top_n
from caseloom.sinks.tables import TableStore
from caseloom.sources.pages import CursorJsonSource, page_rows


def tail_files(spark: SparkSession, folder: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def tail_cursor(spark: SparkSession, source: type[CursorJsonSource] = CursorJsonSource, **options: str) -> DataFrame:
    """Rows of a cursor service as a stream; the offset in the checkpoint is the cursor.

    The driver follows cursors; the pages of a batch are fetched by tasks.
    """
    spark.dataSource.register(source)
    cursors = spark.readStream.format(source.name()).options(**options).load()
    return page_rows(cursors, source, options)


def once_per_key(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay; the state is dropped with the watermark.

    Watermarks need a timestamp with zone, so a zone-less column is cast.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def upsert_batches(
    stream: DataFrame, store: TableStore, table: str, keys: Sequence[str], checkpoint: str,
    order_by: Sequence[Column] | None = None, partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Upsert each micro-batch into a table of the store until the source is drained.

    A batch rewrites only the buckets its keys fall into, or with ``partition_by`` the partitions of those key columns.

    A batch that this checkpoint already applied is skipped by its number; applying one twice would not change the
    table either.
    """
    marker = f"caseloom.batch.{hashlib.md5(checkpoint.encode()).hexdigest()}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        here = TableStore(batch.sparkSession, store.database, store.root)
        if not here.exists(table):
            first = batch if order_by is None else _latest(batch, keys, order_by)
            here.create(table, first, primary_keys=keys, partition_by=partition_by)
        elif int(here.properties(table).get(marker, "-1")) >= batch_id:
            return
        else:
            here.upsert(table, batch, keys, order_by)
        here.set_property(table, marker, str(batch_id))

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def _latest(batch: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    return top_n(batch, keys, order_by, 1, "__n").drop("__n")


def append_batches(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream to a parquet folder; by default until the source is drained."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)


def drain(running: StreamingQuery) -> None:
    """Wait until a continuously running query has read everything there is, then stop it."""
    try:
        running.processAllAvailable()
    finally:
        running.stop()
