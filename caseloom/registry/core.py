"""Registration of named queries together with the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from caseloom.plans.model import ForeignKey, Model, ProcessConfiguration
from caseloom.session import spread_narrow

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "documents", "labels", "events")

KEYS = (
    ForeignKey("lineitem", "orders", (("l_orderkey", "o_orderkey"),)),
    ForeignKey("lineitem", "part", (("l_partkey", "p_partkey"),)),
    ForeignKey("lineitem", "supplier", (("l_suppkey", "s_suppkey"),)),
    ForeignKey("orders", "customer", (("o_custkey", "c_custkey"),)),
    ForeignKey("customer", "nation", (("c_nationkey", "n_nationkey"),)),
    ForeignKey("supplier", "nation", (("s_nationkey", "n_nationkey"),)),
    ForeignKey("nation", "region", (("n_regionkey", "r_regionkey"),)),
    ForeignKey("labels", "documents", (("doc_id", "doc_id"),)),
)

PROCESS = ProcessConfiguration("events", "user_id", "event_type", "ts", "event_id")

# Schemas by path: the footer of a file is read once per process.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """The tables of one data folder, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        # Timestamps without zone are compared with an engine that has no session zone.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def texts(self) -> DataFrame:
        """Documents over all cores: pattern matching on whole texts is bound by the processor, not by reading."""
        return spread_narrow(self("documents"), "doc_id")

    def model(self, *names: str) -> Model:
        """The model of the given tables (default: all) with every key between them."""
        chosen = names or TABLES
        keys = [key for key in KEYS if {key.source, key.target} <= set(chosen)]
        return Model({n: self(n) for n in chosen}, keys, PROCESS)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``, optionally with the SQL it must agree with."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
