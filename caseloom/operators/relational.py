"""Joins, aggregates, ordering and set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.operators.ordered import with_group_position, with_position
from caseloom.session import broadcast_if_small, materialize


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself, after a check that no key repeats."""
    repeated = df.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if repeated:
        raise ValueError(f"keys {list(keys)} repeat, for example {repeated[0]}")
    return df


def enrich_left(
    df: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, known_unique: bool = False
) -> DataFrame:
    """Add columns of ``other`` by key, keeping every row of ``df`` once; repeated right keys are an error.

    ``known_unique`` skips the pass that checks the right keys.
    """
    chosen = other if columns is None else other.select(*keys, *columns)
    return df.join(chosen if known_unique else require_unique(chosen, keys), list(keys), "left")


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Equi-join on differently named keys; the right key column is dropped."""
    return left.join(right, left[left_key] == right[right_key], "inner").drop(right[right_key])


def combine_first(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Union of keys and columns; where both have a column the left value wins and the right fills nulls."""
    lhs, rhs = left.alias("l"), right.alias("r")
    names = [*left.columns, *[c for c in right.columns if c not in left.columns]]

    def pick(name: str) -> Column:
        if name in left.columns and name in right.columns:
            return F.coalesce(F.col(f"l.`{name}`"), F.col(f"r.`{name}`")).alias(name)
        return F.col(f"l.`{name}`" if name in left.columns else f"r.`{name}`")

    on = [F.col(f"l.`{k}`") == F.col(f"r.`{k}`") for k in keys]
    return lhs.join(rhs, on, "full").select(*[pick(n) for n in names])


def fill_from_prior_period(df: DataFrame, value: str, date: str, days: int, keys: Sequence[str] = ()) -> DataFrame:
    """Nulls take the value of the row ``days`` earlier of the same series; one pass, on dates unique per series."""
    earlier = df.select(*keys, (F.col(date) + F.make_dt_interval(days=F.lit(days))).alias(date), F.col(value).alias("__prior"))
    filled = df.join(earlier, [*keys, date], "left")
    return filled.withColumn(value, F.coalesce(value, "__prior")).select(*df.columns)


def remap_ids(
    records: DataFrame, fields: Sequence[str], source: DataFrame, target: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Point nested references at the ids of another store.

    ``source`` and ``target`` hold ``id`` and ``placeholder``; placeholders match without regard to case. Source
    rows without a partner get new ids above the highest target id. ``fields`` are ``struct.field`` references to
    source ids. A null placeholder is a name like others. Returns the records and the complete target table.
    """
    by_name = F.coalesce(F.concat(F.lit("="), F.upper("placeholder")), F.lit("")).alias("__name")
    known = target.groupBy(by_name).agg(F.max("id").alias("new_id"))
    matched = source.select("id", "placeholder", by_name).join(known, "__name", "left")
    missing = matched.where(F.col("new_id").isNull()).groupBy("__name").agg(F.min("placeholder").alias("placeholder"))
    top = F.coalesce(target.agg(F.max("id")).scalar(), F.lit(0))
    created = with_position(missing, "__name", "__pos").select(
        "__name", "placeholder", (top + F.col("__pos") + 1).alias("created_id")
    )
    pairs = matched.join(created.select("__name", "created_id"), "__name", "left").select(
        F.col("id").alias("__old"), F.coalesce("new_id", "created_id").alias("__new")
    )
    mapping = broadcast_if_small(materialize(pairs, "mapping"))
    out = records
    for path in fields:
        struct, leaf = path.rsplit(".", 1)
        out = out.join(mapping, F.col(path) == F.col("__old"), "left")
        out = out.withColumn(struct, F.when(F.col(struct).isNotNull(), F.col(struct).withField(leaf, F.col("__new"))))
        out = out.drop("__old", "__new")
    return out, target.select("id", "placeholder").unionByName(created.select(F.col("created_id").alias("id"), "placeholder"))


def group_summary(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Group by keys without null key rows."""
    return df.dropna("any", subset=list(keys)).groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])


def group_transform(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Group statistics on every row: aggregate first, then join, so that a hot group never lands in one task.

    The statistics are written once; if they are few, the rows are not shuffled at all.
    """
    stats = df.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    small = materialize(stats.withColumnsRenamed({k: f"__{k}" for k in keys}), "groups")
    renamed = broadcast_if_small(small)
    on = [df[k].eqNullSafe(renamed[f"__{k}"]) for k in keys]
    return df.join(renamed, on, "left").select(*[df[c] for c in df.columns], *measures)


def value_counts(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), column)


def binary_metrics(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """Confusion matrix, precision and recall in one pass; a ratio with no cases is null."""

    def cases(t: int, p: int) -> Column:
        return F.count_if((F.col(truth) == t) & (F.col(prediction) == p))

    counts = df.agg(
        cases(0, 0).alias("tn"), cases(0, 1).alias("fp"), cases(1, 0).alias("fn"), cases(1, 1).alias("tp")
    )
    return counts.select(
        "*",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )


def mean_squared_error(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(truth) - F.col(prediction), 2)).alias("mse"))


def top_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group with their rank (bigint). Spark limits each group before the shuffle, so hot groups stay small."""
    window = Window.partitionBy(*keys).orderBy(*order_by)
    ranked = df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    return ranked.withColumn(rank, F.col(rank).cast("bigint"))


def argmax(values: Column) -> Column:
    """0-based index of the first maximum of an array."""
    return F.array_position(values, F.array_max(values)) - 1


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; missing columns are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    return union_all([df.withColumn(tag, F.lit(name)) for name, df in frames.items()])


def append_rows(df: DataFrame, rows: Sequence[Mapping]) -> DataFrame:
    """Add literal rows; absent columns are null."""
    values = [tuple(row.get(c) for c in df.columns) for row in rows]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema])
    return df.unionByName(df.sparkSession.createDataFrame(values, schema))


def fingerprint(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's values as one JSON record."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that were added, removed or changed between two snapshots with the same columns.

    Rows are compared by fingerprint, so only keys and 64 characters per row are shuffled.
    """
    values = [c for c in old.columns if c not in keys]
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("snapshots must have the same columns")

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, fingerprint(values).alias(name))

    both = side(old, "__old").join(side(new, "__new"), list(keys), "full")
    change = (
        F.when(F.col("__old").isNull(), "added")
        .when(F.col("__new").isNull(), "removed")
        .when(F.col("__old") != F.col("__new"), "changed")
    )
    return both.select(*keys, change.alias("change")).where("change is not null")
