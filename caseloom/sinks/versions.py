"""Keyed tables in versions: rows lie in buckets of their key, and a version lists the folders of every bucket.

A change writes new folders for the buckets it touches; the others are carried over by reference. It becomes visible in
one step, when the list of its version appears under the next number. That step fails if the number is taken, so of two
writers the later one starts again from what the earlier one left.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from caseloom.operators.relational import require_unique, top_n
from caseloom.session import materialize

# Rows that a bucket holds at most when a table is laid out; a table of twice as many gets more buckets.
BUCKET_ROWS = 1_000_000
BUCKET = "__bucket"
ATTEMPTS = 20


def latest_rows(source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None) -> DataFrame:
    """One row per key, the first by ``order_by``; without an order a repeated key is an error."""
    return top_n(source, keys, order_by, 1, "__n").drop("__n") if order_by else require_unique(source, keys)


def merge_rows(target: DataFrame, latest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose keys ``latest`` lacks, plus its rows; keys compare null-safe."""
    names = latest.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = [target[k].eqNullSafe(names[f"__{k}"]) for k in keys]
    return target.join(names, same, "left_anti").unionByName(latest.select(*target.columns))


def upsert_result(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """Target rows whose keys the source lacks, plus the source rows; keys compare null-safe.

    Repeated source keys keep the first row by ``order_by``; without an order they are an error.
    """
    return merge_rows(target, latest_rows(source, keys, order_by), keys)


class VersionTaken(Exception):
    """Another writer has published the version number first."""


class VersionedTable:
    """A keyed table below ``path``: ``data`` holds folders of buckets, ``versions`` one JSON list per version.

    Any file system that refuses to rename a file onto an existing one will do. The column name ``__bucket`` is taken.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # Versions

    def versions(self) -> list[int]:
        files, folder = self._files(f"{self.path}/versions")
        if not files.exists(folder):
            return []
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The latest version, or one that is still kept."""
        if version is None:
            known = self.versions()
            if not known:
                raise LookupError(f"no version of a table at {self.path!r}")
            version = known[-1]
        return json.loads(self.spark.read.text(self._list_path(version), wholetext=True).first()[0])

    def paths(self, manifest: dict, buckets: Sequence[str] | None = None) -> list[str]:
        """Folders of all or some buckets."""
        chosen = manifest["folders"] if buckets is None else {b: manifest["folders"].get(b, []) for b in buckets}
        return [f"{self.path}/data/{folder}" for _, folders in sorted(chosen.items()) for folder in folders]

    def read(self, version: int | None = None) -> DataFrame:
        manifest = self.manifest(version)
        return self._rows(manifest, self.paths(manifest))

    def retain(self, keep: int = 2) -> None:
        """Keep the last ``keep`` versions; lists of older ones go first, then folders that no kept version names.

        Not to be run beside a writer: folders of a change that is not published yet would count as unused.
        """
        known = self.versions()
        for version in known[:-keep]:
            files, path = self._files(self._list_path(version))
            files.delete(path, False)
        used = {f for v in known[-keep:] for folders in self.manifest(v)["folders"].values() for f in folders}
        files, root = self._files(f"{self.path}/data")
        for written in files.listStatus(root) if files.exists(root) else []:
            for bucket in files.listStatus(written.getPath()):
                name = f"{written.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and name not in used:
                    files.delete(bucket.getPath(), True)

    # Changes

    def replace(self, df: DataFrame, keys: Sequence[str], bucket_rows: int = BUCKET_ROWS) -> dict:
        """New content and, if it differs, a new schema. The keys must be unique."""
        stored = require_unique(materialize(df, "replace"), keys)
        layout = {"keys": list(keys), "bucket_rows": bucket_rows, "schema": df.schema.jsonValue()}
        layout["buckets"] = _bucket_count(stored.count(), bucket_rows)
        written = self._write(stored, layout)
        return self._publish(lambda seen: layout | written)

    def append(self, df: DataFrame) -> dict:
        """More rows, as further folders of their buckets. Their keys are expected to be new."""
        stored = materialize(df.select(*self._cast(self.manifest())), "append")

        def change(seen: dict) -> dict:
            written = self._write(stored, seen)
            folders, rows = dict(seen["folders"]), dict(seen["rows"])
            for bucket, new in written["folders"].items():
                folders[bucket] = folders.get(bucket, []) + new
                rows[bucket] = rows.get(bucket, 0) + written["rows"][bucket]
            return seen | {"folders": folders, "rows": rows}

        return self._publish(change)

    def upsert(self, df: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[Column] | None = None) -> dict:
        """Insert new keys and update known ones; only the buckets of these keys are read and written.

        The buckets are those of the table's own keys, so other ``keys`` touch all of them. A table that has outgrown its
        buckets is laid out anew in the same step.
        """
        first = self.manifest()
        keys = list(keys or first["keys"])
        latest = materialize(latest_rows(df, keys, order_by).select(*self._cast(first)), "upsert")
        added = latest.count()
        if not added:
            return first

        def change(seen: dict) -> dict:
            total = sum(seen["rows"].values()) + added
            if total > 2 * seen["buckets"] * seen["bucket_rows"]:
                layout = seen | {"buckets": _bucket_count(total, seen["bucket_rows"])}
                return layout | self._write(merge_rows(self._rows(seen, self.paths(seen)), latest, keys), layout)
            if keys == seen["keys"]:
                touched = [str(r[0]) for r in latest.select(_bucket(seen)).distinct().collect()]  # numbers of buckets
            else:
                touched = list({*seen["folders"], *(str(b) for b in range(seen["buckets"]))})
            old = self._rows(seen, self.paths(seen, touched))
            written = self._write(merge_rows(old, latest, keys), seen)
            changed = {part: {b: v for b, v in seen[part].items() if b not in touched} | written[part] for part in ("folders", "rows")}
            return seen | changed

        return self._publish(change)

    def _publish(self, change: Callable[[dict], dict]) -> dict:
        for _ in range(ATTEMPTS):
            known = self.versions()
            seen = self.manifest(known[-1]) if known else {}
            new = change(seen) | {"version": known[-1] + 1 if known else 0}
            try:
                self._list(new)
                return new
            except VersionTaken:
                continue
        raise RuntimeError(f"other writers were faster {ATTEMPTS} times")

    def _list(self, manifest: dict) -> None:
        """Write the list under a name of its own and rename it, which fails if the number is taken."""
        jvm = self.spark._jvm
        files, staged = self._files(f"{self.path}/versions/.{uuid.uuid4().hex}")
        out = files.create(staged, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = jvm.org.apache.hadoop.fs.Path(self._list_path(manifest["version"]))
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(staged, target, options)
        except Py4JJavaError as error:
            files.delete(staged, False)
            if "FileAlreadyExists" in str(error.java_exception):
                raise VersionTaken(manifest["version"]) from None
            raise

    def _write(self, df: DataFrame, layout: dict) -> dict:
        """Folders and row counts of the buckets that ``df`` has rows for."""
        name = uuid.uuid4().hex
        path = f"{self.path}/data/{name}"
        placed = df.withColumn(BUCKET, _bucket(layout)).repartition(layout["buckets"], BUCKET)
        placed.write.partitionBy(BUCKET).parquet(path)
        written = self.spark.read.schema(StructType(df.schema.fields).add(BUCKET, IntegerType())).parquet(path)
        rows = {str(r[0]): r[1] for r in written.groupBy(BUCKET).count().collect()}  # one row per bucket
        return {"folders": {b: [f"{name}/{BUCKET}={b}"] for b in rows}, "rows": rows}

    def _rows(self, manifest: dict, paths: list[str]) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _cast(self, manifest: dict) -> list[Column]:
        return [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in StructType.fromJson(manifest["schema"])]

    def _list_path(self, version: int) -> str:
        return f"{self.path}/versions/v{version:010d}.json"

    def _files(self, path: str):
        """The session's own file system of a path, and the path in its form."""
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found


def _bucket(layout: dict) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in layout["keys"]]), F.lit(layout["buckets"])).cast("int").alias(BUCKET)


def _bucket_count(rows: int, bucket_rows: int) -> int:
    """The power of two that leaves a bucket ``bucket_rows`` at most, on average."""
    return 1 << max(0, (max(rows, 1) - 1) // bucket_rows).bit_length()
