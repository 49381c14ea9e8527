import datetime as dt
import json

import pytest
from conftest import rows
from pyspark import TaskContext

from caseloom.sinks.tables import TableStore
from caseloom.sources.pages import CursorJsonSource
from caseloom.streaming.ingest import append_batches, drain, once_per_key, tail_cursor, tail_files, upsert_batches


@pytest.fixture()
def arrivals(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "ts", "value")
    path = str(tmp_path / "arrivals")
    for half in (0, 1):
        events.where(f"event_id % 2 = {half}").coalesce(1).write.mode("append").parquet(path)
    return events, path


def test_replayed_files_do_not_change_the_table(spark, arrivals, tmp_path):
    events, path = arrivals
    store = TableStore(spark, "stream_tests", str(tmp_path / "store"))

    def run(checkpoint):
        stream = once_per_key(tail_files(spark, path, events.schema, files_per_batch=1), ["event_id"], "ts", "60 days")
        upsert_batches(stream, store, "events", ["event_id"], str(tmp_path / checkpoint)).awaitTermination()

    run("first")
    want = rows(events.select("event_id", "value"))
    assert rows(store.read("events").select("event_id", "value")) == want
    events.where("event_id < 100").coalesce(1).write.mode("append").parquet(path)
    run("first")
    assert rows(store.read("events").select("event_id", "value")) == want
    run("second")  # everything again, under a new checkpoint
    assert rows(store.read("events").select("event_id", "value")) == want


def test_cursor_is_followed_and_resumed(spark, tmp_path):
    chain = {"a": ([1, 2], "c"), "c": ([3], "b"), "b": ([4, 5], None)}
    for cursor, (ids, following) in chain.items():
        page = {"logs": [{"id": i, "extra": "x"} for i in ids], "following": following}
        (tmp_path / f"{cursor}.json").write_text(json.dumps(page))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        stream = tail_cursor(spark, folder=str(tmp_path), start="a", row_schema="id int", next_key="following")
        drain(append_batches(stream, out, checkpoint, available_now=False))
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert run() == [1, 2, 3, 4, 5]
    assert run() == [1, 2, 3, 4, 5]


def test_pages_are_fetched_by_tasks(spark, tmp_path):
    class TaskPages(CursorJsonSource):
        """A service whose pages only tasks may fetch; cursors come without them."""

        @classmethod
        def name(cls):
            return "task_pages"

        def fetch(self, cursor):
            if TaskContext.get() is None:
                raise RuntimeError("page fetched outside a task")
            at = int(cursor)
            return {"logs": [{"id": at * 10 + i, "at": "2024-01-02 03:04:05", "tags": ["x"] * i} for i in range(3)]}

        def next_cursor(self, cursor):
            return str(int(cursor) + 1) if int(cursor) < 11 else None

    stream = tail_cursor(spark, TaskPages, start="0", row_schema="id int, at timestamp_ntz, tags array<string>", pages_per_batch="5", next_key="")
    out = str(tmp_path / "out")
    drain(append_batches(stream, out, str(tmp_path / "checkpoint"), available_now=False))
    got = spark.read.parquet(out).orderBy("id").collect()
    assert [r.id for r in got] == [at * 10 + i for at in range(12) for i in range(3)]
    assert {r["at"] for r in got} == {dt.datetime(2024, 1, 2, 3, 4, 5)} and got[-1].tags == ["x", "x"]


def test_batches_grow_while_pages_wait(spark, tmp_path):
    for i in range(40):
        page = {"logs": [{"id": i}], "following": str(i + 1) if i < 39 else None}
        (tmp_path / f"{i}.json").write_text(json.dumps(page))
    stream = tail_cursor(spark, folder=str(tmp_path), start="0", row_schema="id int", next_key="following", pages_per_batch="2", catch_up_pages="16")
    out = str(tmp_path / "out")
    running = append_batches(stream, out, str(tmp_path / "checkpoint"), available_now=False)
    drain(running)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(40))
    # One row a page; without growth there would be 20 batches of 2.
    assert [p["numInputRows"] for p in running.recentProgress if p["numInputRows"]] == [2, 4, 8, 16, 10]
