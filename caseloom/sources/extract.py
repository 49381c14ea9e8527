"""Bounded, incremental and unified extraction from tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.relational import top_n


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


def trailing_days(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Rows of the ``days`` days before the day ``as_of`` and of that day; a range that reaches the scan."""
    end = F.lit(as_of).cast("date")
    first = F.date_sub(end, days).cast("timestamp_ntz")
    after = F.date_add(end, 1).cast("timestamp_ntz")
    return df.where((F.col(ts) >= first) & (F.col(ts) < after))


def incremental_extract(
    source: DataFrame, target: DataFrame, created: str, created_from: str, created_to: str, changed: str, offset_days: int
) -> DataFrame:
    """Source rows created in a range and changed since the target's last change minus an offset.

    An empty target takes every row of the creation range.
    """
    newest = target.agg(F.max(changed)).scalar()
    since = newest - F.make_dt_interval(days=F.lit(offset_days))
    in_range = (F.col(created) >= _moment(created_from)) & (F.col(created) <= _moment(created_to))
    return source.where(in_range).where(newest.isNull() | (F.col(changed) >= since))


def unify_sources(sources: Mapping[str, DataFrame], keys: Sequence[str] = (), tag: str = "source") -> DataFrame:
    """Union of several extractions by column name with their name; repeated keys keep the first source's row."""
    frames = [df.select(F.lit(i).alias("__rank"), F.lit(name).alias(tag), "*") for i, (name, df) in enumerate(sources.items())]
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    if keys:
        rest = [F.col(c) for c in combined.columns if c not in {*keys, "__rank"}]
        combined = top_n(combined, keys, [F.col("__rank"), *rest], 1, "__n").drop("__n")
    return combined.drop("__rank")
