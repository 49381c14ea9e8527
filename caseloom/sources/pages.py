"""Spark data sources for services that answer in pages or by cursor.

Subclasses supply the request; the default reads page files from a shared folder, which is also the offline form.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    InputPartition,
    SimpleDataSourceStreamReader,
)

from caseloom.session import open_store


def read_pages(folder: str, name: str) -> list[str]:
    """Text of the files ``folder/name`` (a file or a folder of part files); empty if it does not exist."""
    store, path = open_store(f"{folder.rstrip('/')}/{name}")
    info = store.get_file_info(path)
    if info.type == fs.FileType.Directory:
        found = sorted(f.path for f in store.get_file_info(fs.FileSelector(path)) if f.base_name.startswith("part-"))
    else:
        found = [path] if info.type == fs.FileType.File else []
    texts = []
    for p in found:
        with store.open_input_stream(p) as f:
            texts.append(f.read().decode("utf-8"))
    return texts


def _values(schema, row: dict) -> tuple:
    return tuple(row.get(f.name) for f in schema)


class PageRange(InputPartition):
    """A stride of page numbers: ``start, start + step, ...``."""

    def __init__(self, start: int, step: int):
        self.start, self.step = start, step


class PagedJsonSource(DataSource):
    """Batch source over numbered pages: one row (page, rows) per page, also for the empty page that ends a walk.

    Options: ``folder``, ``row_schema``, ``rows_key``, ``readers`` (parallel page walkers). Each walker stops at its own first
    empty page; ``sources.json.paged_service`` keeps what is before the first of all.
    """

    @classmethod
    def name(cls) -> str:
        return "caseloom_paged_json"

    def schema(self) -> str:
        return f"page bigint, rows array<struct<{self.options['row_schema']}>>"

    def fetch(self, page: int) -> list[dict]:
        """Rows of a page; an empty list past the last page. The first page must exist."""
        texts = read_pages(self.options["folder"], f"page-{page}.json")
        if page == 0 and not texts:
            raise LookupError(f"no first page in {self.options['folder']!r}")
        return json.loads(texts[0])[self.options.get("rows_key", "rows")] if texts else []

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(self, schema)


class _PageReader(DataSourceReader):
    def __init__(self, source: PagedJsonSource, schema):
        self.source, self.row_schema = source, schema

    def partitions(self) -> list[PageRange]:
        readers = int(self.source.options.get("readers", "8"))
        return [PageRange(i, readers) for i in range(readers)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        page, fields = partition.start, self.row_schema["rows"].dataType.elementType
        while rows := self.source.fetch(page):
            yield page, [_values(fields, row) for row in rows]
            page += partition.step
        yield page, []


class CursorJsonSource(DataSource):
    """Stream of cursors, one row per page; its offset is the cursor of the next page. ``page_rows`` fetches the pages.

    Each cursor is known only from the page before, so cursors are followed one after the other; a micro-batch holds
    ``pages_per_batch`` of them. With ``catch_up_pages`` every full batch doubles the next one up to so many pages, so that a
    long backlog is not bound by the start-up of its batches; a batch that reaches the end goes back to the first size.
    Options: ``folder``, ``row_schema``, ``rows_key``, ``next_key``, ``start``, ``prefix``, ``suffix``.
    """

    @classmethod
    def name(cls) -> str:
        return "caseloom_cursor_json"

    def schema(self) -> str:
        return "cursor string"

    def fetch(self, cursor: str) -> dict:
        """The page that starts at a cursor: its rows and the next cursor, or null when drained."""
        texts = read_pages(self.options["folder"], f"{self.options.get('prefix', '')}{cursor}{self.options.get('suffix', '.json')}")
        if not texts:
            raise LookupError(f"no page at cursor {cursor!r}")
        return json.loads(texts[0])

    def next_cursor(self, cursor: str) -> str | None:
        """The cursor after a page. A service that tells it without the rows should be asked so; here the rows are dropped."""
        return self.fetch(cursor).get(self.options["next_key"])

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _CursorReader(self)


def batch_pages(options: Mapping[str, str]) -> tuple[int, int]:
    """Pages of the first micro-batch and of the largest."""
    first = int(options.get("pages_per_batch", "1"))
    return first, max(first, int(options.get("catch_up_pages", first)))


class _CursorReader(SimpleDataSourceStreamReader):
    def __init__(self, source: CursorJsonSource):
        self.source = source
        self.first, self.most = batch_pages(source.options)
        self.pages = self.first

    def initialOffset(self) -> dict:
        return {"cursor": self.source.options["start"]}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, cursor = [], start["cursor"]
        for _ in range(self.pages):
            if cursor is None:
                break
            rows.append((cursor,))
            cursor = self.source.next_cursor(cursor)
        self.pages = self.first if cursor is None else min(2 * self.pages, self.most)
        # Spark copies the iterator of a cached batch, so it is one over a list.
        return iter(rows), {"cursor": cursor}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """Replay after a failure: walk the cursors from start to end."""
        cursor = start["cursor"]
        while cursor is not None and cursor != end["cursor"]:
            yield (cursor,)
            cursor = self.source.next_cursor(cursor)


def page_rows(cursors: DataFrame, source: type[CursorJsonSource], options: dict[str, str]) -> DataFrame:
    """Rows of the pages at the cursors; tasks fetch the pages, each its share of a batch."""
    key = options.get("rows_key", "logs")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        service = source(options)
        for batch in batches:
            for cursor in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"rows": pa.array([json.dumps(service.fetch(cursor)[key])], pa.string())})

    tasks = min(batch_pages(options)[1], cursors.sparkSession.sparkContext.defaultParallelism)
    pages = cursors.repartition(tasks).mapInArrow(fetch, "rows string")
    parsed = F.from_json("rows", f"array<struct<{options['row_schema']}>>", {"mode": "FAILFAST"})
    return pages.select(F.inline(parsed))
