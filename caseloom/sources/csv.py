"""CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caseloom.operators.relational import union_all


def scan_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header. Give a schema in production; without one the types are inferred by an extra pass."""
    reader = spark.read.option("header", True).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def combine_csv(spark: SparkSession, folder: str, same_header: bool = False, **options) -> DataFrame:
    """All CSV files of a folder as one frame, columns matched by name.

    Spark matches columns of several files by position, so files are grouped by header first (one distributed text
    pass; only distinct headers with their file names reach the driver). ``same_header`` skips that pass.
    """
    if same_header:
        return scan_csv(spark, folder, pathGlobFilter="*.csv", **options)
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value"
    )
    numbered = lines.withColumn("id", F.monotonically_increasing_id()).where("start = 0")
    headers = numbered.groupBy("path").agg(F.min_by("value", "id").alias("header"))
    groups = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header").collect()
    if not groups:
        raise FileNotFoundError(f"no CSV files in {folder!r}")
    return union_all([scan_csv(spark, row["paths"], **options) for row in groups])


# A record: runs of plain characters and quoted fields, each taken whole, so that its length does not deepen the matching.
_RECORD = r'(?:[^"\r\n]++|"[^"]*+(?:""[^"]*+)*+"?)++'


def csv_payload(df: DataFrame, text: str, schema: str, keep: list[str] | None = None, header: bool = True, sep: str = ",") -> DataFrame:
    """Rows of CSV text held in a column; the first record of each text is its header. Quoted fields may hold line breaks.

    Records may be of any length. A quote that is never closed reaches to the end of the text.
    """
    records = F.regexp_extract_all(text, F.lit(_RECORD), F.lit(0))
    lines = df.select(*(keep or []), F.posexplode(records).alias("__i", "__line"))
    data = lines.where((F.col("__i") > 0) if header else F.lit(True)).where(F.length(F.trim("__line")) > 0)
    options = {"sep": sep, "multiLine": "true", "escape": '"', "maxCharsPerColumn": "-1"}
    return data.select(*(keep or []), F.from_csv("__line", schema, options).alias("__r")).select(*(keep or []), "__r.*")
