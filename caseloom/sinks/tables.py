"""Publishing frames as tables: replace, append, error, upsert.

A table with keys is a ``VersionedTable`` below the store's root with a view over the folders of its latest version; upserts
and appends leave the buckets they do not touch as they are, and writers do not overwrite each other's changes. A table
without keys, or partitioned by columns, is an external parquet table: a replace writes a complete new version and then
points the catalog entry at it, so readers never see half a table; concurrent writers of one are not coordinated.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseloom.operators.relational import require_unique
from caseloom.plans.model import ForeignKey, Model
from caseloom.session import materialize
from caseloom.sinks.versions import VersionedTable, upsert_result


class TableStore:
    """Named tables of one database with their files below ``root``."""

    def __init__(self, spark: SparkSession, database: str, root: str):
        self.spark, self.database, self.root = spark, database, root.rstrip("/")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{database}.db'")

    def full_name(self, name: str) -> str:
        return f"`{self.database}`.`{name}`"

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{name}")

    def read(self, name: str) -> DataFrame:
        kept = self.versioned(name)
        return kept.read() if kept else self.spark.table(self.full_name(name))

    def versioned(self, name: str) -> VersionedTable | None:
        """The versions behind a table with keys; none for other tables."""
        path = self.properties(name).get("caseloom.versions")
        return VersionedTable(self.spark, path) if path else None

    def retain(self, name: str, keep: int = 2) -> None:
        """Give up all but the last ``keep`` versions of a table with keys."""
        self.versioned(name).retain(keep)

    def create(self, name: str, data: DataFrame | str, types: Mapping[str, str] | None = None,
               primary_keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
        """New table; an existing one is an error."""
        if self.exists(name):
            raise ValueError(f"table {name!r} already exists")
        self._define(name, self._frame(data, types), primary_keys, partition_by)

    def replace(self, name: str, data: DataFrame | str, types: Mapping[str, str] | None = None,
                primary_keys: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
        """Table with new content and, if it differs, a new schema."""
        self._define(name, self._frame(data, types), primary_keys, partition_by)

    def append(self, name: str, data: DataFrame | str) -> None:
        """Add rows; column names and types must fit the table."""
        table = self.read(name)
        df = self._frame(data, None)
        if sorted(df.columns) != sorted(table.columns):
            raise ValueError(f"columns {sorted(df.columns)} do not fit {sorted(table.columns)}")
        if kept := self.versioned(name):
            kept.append(df)
            self._point(name, kept)
        else:
            df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in table.schema]).write.insertInto(self.full_name(name))

    def upsert(self, name: str, data: DataFrame | str, keys: Sequence[str] | None = None,
               order_by: Sequence[Column] | None = None) -> None:
        """Insert new keys and update known ones; only touched buckets, or touched partitions of key columns, are rewritten.

        A table that is neither in versions nor partitioned by key columns is laid out in versions by its first upsert.
        """
        df = self._frame(data, None)
        if kept := self.versioned(name):
            kept.upsert(df, keys, order_by)
            self._point(name, kept)
            return
        table = self.read(name)
        keys = list(keys or self.primary_keys(name))
        if not keys:
            raise ValueError("upsert needs primary keys")
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in table.schema])
        parts = self.partition_columns(name)
        if parts and set(parts) <= set(keys):
            touched = df.select(*parts).distinct()
            same = [table[p].eqNullSafe(touched[p]) for p in parts]
            merged = materialize(upsert_result(table.join(touched, same, "left_semi"), df, keys, order_by), "upsert")
            self._overwrite_partitions(name, merged)
            return
        self._define(name, upsert_result(table, df, keys, order_by), keys, parts)

    def append_or_create(self, name: str, data: DataFrame | str, model: Model | None = None, key: ForeignKey | None = None) -> None:
        """Append to a history table; on its first use create it and register it with its foreign key in the model."""
        if self.exists(name):
            self.append(name, data)
            return
        self.create(name, data)
        if model is not None:
            model.add_table(name, self.read(name))
            if key is not None:
                model.add_key(key)

    def primary_keys(self, name: str) -> list[str]:
        return [k for k in self.properties(name).get("caseloom.keys", "").split(",") if k]

    def partition_columns(self, name: str) -> list[str]:
        return [c.name for c in self.spark.catalog.listColumns(f"{self.database}.{name}") if c.isPartition]

    def properties(self, name: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.full_name(name)}").collect()}

    def set_property(self, name: str, key: str, value: str) -> None:
        kind = "VIEW" if self._is_view(name) else "TABLE"
        self.spark.sql(f"ALTER {kind} {self.full_name(name)} SET TBLPROPERTIES ('{key}' = '{value}')")

    def _is_view(self, name: str) -> bool:
        return self.spark.catalog.getTable(f"{self.database}.{name}").tableType == "VIEW"

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP {'VIEW' if self._is_view(name) else 'TABLE'} {self.full_name(name)}")

    def _point(self, name: str, kept: VersionedTable) -> None:
        """Let the view of a table show its latest version."""
        manifest = kept.manifest()
        schema = StructType.fromJson(manifest["schema"])
        folders = [path.removeprefix(f"{kept.path}/data/") for path in kept.paths(manifest)]
        if folders:
            chosen = f"{{{','.join(folders)}}}" if len(folders) > 1 else folders[0]
            body = f"SELECT {', '.join(f'`{c}`' for c in schema.names)} FROM parquet.`{kept.path}/data/{chosen}`"
        else:
            body = "SELECT " + ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema) + " WHERE false"
        if self.exists(name):
            self.spark.sql(f"ALTER VIEW {self.full_name(name)} AS {body}")
        else:
            properties = f"'caseloom.versions' = '{kept.path}', 'caseloom.keys' = '{','.join(manifest['keys'])}'"
            self.spark.sql(f"CREATE VIEW {self.full_name(name)} TBLPROPERTIES ({properties}) AS {body}")

    def _overwrite_partitions(self, name: str, df: DataFrame) -> None:
        """Replace the partitions present in ``df`` and leave the others."""
        mode = "spark.sql.sources.partitionOverwriteMode"
        earlier = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            df.write.mode("overwrite").insertInto(self.full_name(name))
        finally:
            self.spark.conf.set(mode, earlier)

    def _frame(self, data: DataFrame | str, types: Mapping[str, str] | None) -> DataFrame:
        if isinstance(data, str):
            csv = data.endswith(".csv")
            data = self.spark.read.csv(data, header=True, inferSchema=True) if csv else self.spark.read.parquet(data)
        return data.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()}) if types else data

    def _define(self, name: str, df: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> None:
        """Write a version of the table and point the catalog entry at it. Keys must be unique."""
        location = f"{self.root}/{self.database}/{name}/{uuid.uuid4().hex}"
        known = self.exists(name)
        if keys and not partition_by:
            kept = self.versioned(name) if known else None
            if kept is None:
                kept = VersionedTable(self.spark, location)
            kept.replace(df, keys)
            if known and (not self._is_view(name) or self.primary_keys(name) != list(keys)):
                self._drop(name)
            self._point(name, kept)
            return
        if keys:
            require_unique(df, keys)
        if known and self._is_view(name):
            df = materialize(df, "replace")
            self._drop(name)
            known = False
        if known and not partition_by and not self.partition_columns(name) and self.read(name).schema == df.schema:
            df.write.parquet(location)
            self.spark.sql(f"ALTER TABLE {self.full_name(name)} SET LOCATION '{location}'")
            self.spark.catalog.refreshTable(self.full_name(name))
        else:
            staged = f"{name}__{uuid.uuid4().hex[:8]}"
            writer = df.write.format("parquet").option("path", location)
            (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(self.full_name(staged))
            if known:
                self._drop(name)
            self.spark.sql(f"ALTER TABLE {self.full_name(staged)} RENAME TO {self.full_name(name)}")
        if keys:
            self.set_property(name, "caseloom.keys", ",".join(keys))
