"""JSON sources: pages, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseloom.session import materialize
from caseloom.sources.pages import PagedJsonSource


def paged_json(spark: SparkSession, folder: str, rows_key: str, row_schema: str) -> DataFrame:
    """Rows under one key of numbered page files, up to the first empty page.

    Pages are read in parallel. The page number is the number in the file name.
    """
    pages = spark.read.schema(f"{rows_key} array<struct<{row_schema}>>").option("multiLine", True).json(folder)
    numbered = pages.select(
        F.regexp_extract("_metadata.file_name", r"(\d+)", 1).cast("bigint").alias("page"), F.col(rows_key).alias("rows")
    )
    return rows_until_empty(numbered)


def rows_until_empty(pages: DataFrame) -> DataFrame:
    """Rows of ``(page, rows)`` up to the first page without any."""
    sizes = pages.select("page", F.coalesce(F.size("rows"), F.lit(0)).alias("n"))
    first_empty = sizes.where(F.col("n") <= 0).agg(F.min("page")).scalar()
    used = pages.where(first_empty.isNull() | (F.col("page") < first_empty))
    return used.select("page", F.inline("rows"))


def paged_service(spark: SparkSession, source: type[PagedJsonSource], **options) -> DataFrame:
    """The same from a page service: pages are fetched once, by the executors, and stored before the end is known."""
    spark.dataSource.register(source)
    pages = materialize(spark.read.format(source.name()).options(**options).load(), "pages")
    return rows_until_empty(pages).drop("page")


def parse_records(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Text column with JSON objects to a struct column of the same name."""
    return df.withColumn(column, F.from_json(column, schema))


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs to columns with dotted names; arrays stay arrays."""

    def leaves(schema: StructType, path: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for f in schema:
            here = (*path, f.name)
            found += leaves(f.dataType, here) if isinstance(f.dataType, StructType) else [here]
        return found

    return df.select(*[
        F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)) for path in leaves(df.schema, ())
    ])
