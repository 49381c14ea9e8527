"""Projection, filter, null and type operators on tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.relational import union_all


def project(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Named expressions: ``{name: Spark SQL expression}``."""
    return df.select(*[F.expr(text).alias(name) for name, text in columns.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no columns {sorted(missing)}")
    return df.withColumnsRenamed(dict(names))


def flag(condition: Column, yes, no) -> Column:
    """``yes`` where the condition holds, else ``no``; an unknown condition counts as not holding."""
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def composite_key(df: DataFrame, parts: Sequence[str], name: str = "case_key", sep: str = "|") -> DataFrame:
    """Row key from several columns; null if any part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(sep)] * bool(pieces) + [F.col(part).cast("string")]
    return df.withColumn(name, F.concat(*pieces))


def contains_pattern(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).rlike(pattern))


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Float NaN and null are one missing value; done once at the source."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    chosen = [c for c in floats if columns is None or c in columns]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in chosen})


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no null in the given columns (default: in any)."""
    return df.dropna("any", subset=list(columns) if columns else None)


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(column, F.lit(value)))


def fill_mean(df: DataFrame, column: str) -> DataFrame:
    """Nulls become the column mean, computed as a scalar subquery."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(column, mean))


def drop_sparse_columns(df: DataFrame, min_non_null: float = 0.9) -> DataFrame:
    """Keep columns with at least ``floor(rows * min_non_null)`` values. Runs one counting pass: the schema depends on it."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    needed = int(counts["__rows"] * min_non_null)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] >= needed])


def cap_outliers(df: DataFrame, column: str, maximum: float) -> DataFrame:
    """Values above the maximum become the maximum; nulls stay null."""
    return df.withColumn(column, F.when(F.col(column) > maximum, F.lit(maximum)).otherwise(F.col(column)))


def clamp_negative(c: Column) -> Column:
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def any_over(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    """Rows where at least one column is above the threshold."""
    return df.where(F.exists(F.array(*columns), lambda x: x > threshold))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Change types; values that do not convert become null, or raise when ``strict``."""
    return df.withColumns({
        c: F.col(c).cast(kind) if strict else F.col(c).try_cast(kind) for c, kind in types.items()
    })


def column_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, nulls and distinct values.

    Every column is scanned and counted for itself, so a table on disk is read once in all and no row is copied; store a
    frame that is costly to make first.
    """
    return union_all([_scan(df, f, F.countDistinct(F.col(f"`{f.name}`")).alias("distinct")) for f in df.schema])


def _scan(df: DataFrame, field, measure: Column) -> DataFrame:
    value = F.col(f"`{field.name}`")
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("__known"), measure)
    rest = [c for c in counted.columns if c not in ("n", "__known")]
    return counted.select(
        F.lit(field.name).alias("column"), F.lit(field.dataType.simpleString()).alias("type"), "n", (F.col("n") - F.col("__known")).alias("nulls"), *rest
    )


def profile_state(df: DataFrame, precision: int = 14) -> DataFrame:
    """The profile of a snapshot in a form that merges: counts, and a sketch of the distinct values of every column.

    Stored per snapshot, states give the profile of any union of them by ``merge_profiles`` without reading rows again. The
    relative standard error of a distinct count is about 1 / sqrt(2 ** precision), 0.8 % by default. Values that are
    neither whole numbers nor text nor bytes are compared as text.
    """
    plain = ("int", "bigint", "string", "binary")
    columns = [(f, F.col(f"`{f.name}`")) for f in df.schema]
    sketches = [F.hll_sketch_agg(c if f.dataType.simpleString() in plain else c.cast("string"), precision) for f, c in columns]
    return union_all([_scan(df, f, sketch.alias("sketch")) for (f, _), sketch in zip(columns, sketches)])


def merge_profiles(states: DataFrame) -> DataFrame:
    """The profile of all rows behind some states; distinct values are estimates."""
    merged = states.groupBy("column", "type").agg(F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", "type", "n", "nulls", F.hll_sketch_estimate("sketch").alias("distinct"))


def target_rate(df: DataFrame, target: str) -> DataFrame:
    return df.agg((F.avg(target) * 100.0).alias("target_rate"))
