"""Queries over the text tables, one per operator, with production parameters and whole results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under ``name``, optionally with the SQL it must agree with."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder; text passes get small Arrow batches, as single texts can be long."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Importing the operators' query modules fills the two dictionaries.
from caseloom.llm import queries  # noqa: E402, F401
