"""File exports: locale CSV, reports, partitioned snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.functions.strings import decimal_comma


def locale_csv_frame(df: DataFrame) -> DataFrame:
    """Floats and decimals as text with a decimal comma; other columns as they are."""
    numbers = (T.DoubleType, T.FloatType, T.DecimalType)
    return df.select(*[
        decimal_comma(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, numbers) else F.col(f"`{f.name}`")
        for f in df.schema
    ])


def write_locale_csv(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """CSV directory with ``;`` between fields and a time stamp in its name."""
    path = f"{folder.rstrip('/')}/{name}_{stamp}"
    locale_csv_frame(df).write.option("sep", ";").option("header", True).csv(path)
    return path


def export_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Report table as parquet or CSV directory."""
    df.write.format(fmt).option("header", True).mode("overwrite").save(path)


def snapshot_rows(df: DataFrame, published: Column, stamp: str, keep: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Published items with their content as one JSON record and a snapshot stamp."""
    return df.where(published).select(*keep, F.to_json(F.struct(*content)).alias("record"), F.lit(stamp).alias("snapshot"))


def write_snapshot(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """JSON lines, one folder per combination of the partition columns."""
    rows.write.partitionBy(*partition_by).mode("errorifexists").json(path)
