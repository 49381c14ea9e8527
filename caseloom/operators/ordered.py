"""Order-dependent operators that never put a whole table or a hot group into one task.

A window without keys, or with one key that holds a third of the rows, sends that many rows to a single task.
The functions here count group sizes first. Ordinary groups take the plain window; the rows of hot groups are numbered
with one range-partitioned sort and cut into overlapping blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from caseloom.session import materialize

# Largest group one task may sort; above it the blocked form is used.
GROUP_ROWS = 2_000_000
# Own rows per block of the blocked form.
BLOCK_ROWS = 250_000

# monotonically_increasing_id keeps the row number inside its partition in the low 33 bits.
_ROW_BITS = 33

Order = Sequence[str | Column]


def _sort_columns(order_by: str | Column | Order) -> list[Column]:
    items = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    if not items:
        raise ValueError("an order is required: Spark tables have no row order of their own")
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in items]


def split_hot(df: DataFrame, keys: Sequence[str], group_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Rows of ordinary groups and rows of groups larger than ``group_rows`` (None where there are none).

    Sizes are counted with map-side combine. There are at most rows / ``group_rows`` hot keys, so their list can be
    broadcast whatever the size of the table.
    """
    if not keys:
        return (df, None) if df.count() <= group_rows else (None, df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    if (sizes.agg(F.max("__n")).first()[0] or 0) <= group_rows:
        return df, None
    large = sizes.where(F.col("__n") > group_rows)
    hot = materialize(large.select(*[F.col(k).alias(f"__hot{i}") for i, k in enumerate(keys)]), "hot")
    same = [df[k].eqNullSafe(hot[f"__hot{i}"]) for i, k in enumerate(keys)]
    return df.join(F.broadcast(hot), same, "left_anti"), df.join(F.broadcast(hot), same, "left_semi")


def with_position(df: DataFrame, order_by: str | Column | Order, name: str = "position") -> DataFrame:
    """Contiguous 0-based position in a total order, without a global window.

    One range-partitioned sort numbers rows inside each partition; the partition sizes (one row per partition)
    give the offsets. The order must be total, otherwise ties are numbered arbitrarily.
    """
    numbered = materialize(
        df.orderBy(*_sort_columns(order_by)).withColumn("__id", F.monotonically_increasing_id()), "position"
    )
    part = F.shiftright("__id", _ROW_BITS)
    row = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy(part.alias("__part"))
        .agg((F.max(row) + 1).alias("__rows"))
        .select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
    )
    return (
        numbered.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")  # one row per sort partition
        .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("__offset") + row).alias(name))
    )


def _hot_positions(hot: DataFrame, keys: Sequence[str], order: list[Column], name: str) -> DataFrame:
    """1-based positions in hot groups: global positions minus the first one of the group."""
    if not keys:
        return with_position(hot, order, name).withColumn(name, F.col(name) + 1)
    placed = with_position(hot, [*keys, *order], "__pos")
    starts = placed.groupBy(*keys).agg(F.min("__pos").alias("__first"))
    starts = starts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__first")
    same = [placed[k].eqNullSafe(starts[f"__k{i}"]) for i, k in enumerate(keys)]
    joined = placed.join(F.broadcast(starts), same)  # one row per hot key
    return joined.select(*[placed[c] for c in hot.columns], (F.col("__pos") - F.col("__first") + 1).alias(name))


def with_group_position(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column | Order,
    name: str = "position",
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """1-based position inside each key group."""
    order = _sort_columns(order_by)
    rest, hot = split_hot(df, keys, group_rows)
    parts = []
    if rest is not None:
        window = Window.partitionBy(*keys).orderBy(*order)
        parts.append(rest.withColumn(name, F.row_number().over(window).cast("bigint")))
    if hot is not None:
        parts.append(_hot_positions(hot, keys, order, name))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str | Column | Order,
    columns: dict[str, Callable[[WindowSpec], Column]],
    before: int = 0,
    after: int = 0,
    bounded: bool = False,
    group_rows: int = GROUP_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``before`` rows back and ``after`` rows ahead.

    ``columns`` maps a name to a function of the ordered window. ``bounded=True`` says that the group size is
    limited by construction (one row per series and grid date), which skips the size check.
    """
    order = _sort_columns(order_by)
    rest, hot = (df, None) if bounded else split_hot(df, keys, group_rows)
    parts = []
    if rest is not None:
        window = Window.partitionBy(*keys).orderBy(*order)
        parts.append(rest.select("*", *[make(window).alias(name) for name, make in columns.items()]))
    if hot is not None:
        parts.append(_over_blocks(hot, keys, order, columns, before, after, max(block_rows, before + after)))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _over_blocks(
    hot: DataFrame, keys: Sequence[str], order: list[Column], columns: dict[str, Callable[[WindowSpec], Column]],
    before: int, after: int, block_rows: int,
) -> DataFrame:
    """Window columns of hot groups, computed in blocks of positions with the overlap the frames need."""
    placed = _hot_positions(hot, keys, order, "__pos").withColumn("__pos", F.col("__pos") - 1)
    own = F.floor(F.col("__pos") / block_rows)
    inside = F.col("__pos") - own * block_rows
    # Rows near a block edge are also copied to the neighbour that needs them in its frames.
    targets = F.array_compact(
        F.array(
            F.struct(own.alias("block"), F.lit(True).alias("own")),
            F.when(inside >= block_rows - before, F.struct((own + 1).alias("block"), F.lit(False).alias("own"))),
            F.when((inside < after) & (own > 0), F.struct((own - 1).alias("block"), F.lit(False).alias("own"))),
        )
    )
    copied = placed.withColumn("__to", F.explode(targets)).withColumn("__block", F.col("__to.block"))
    window = Window.partitionBy(*keys, "__block").orderBy("__pos")
    return (
        copied.select("*", *[make(window).alias(name) for name, make in columns.items()])
        .where("__to.own")
        .select(*[F.col(f"`{c}`") for c in hot.columns], *columns)
    )


def rolling_mean(
    df: DataFrame,
    value: str,
    order_by: str | Column | Order,
    window: int,
    keys: Sequence[str] = (),
    center: bool = False,
    min_periods: int | None = None,
    name: str = "rolling_mean",
    **options,
) -> DataFrame:
    """Mean over a window of rows; null until ``min_periods`` (default: the full window) non-null values exist.

    A centred even window looks one row further back than ahead.
    """
    before, after = (window // 2, (window - 1) // 2) if center else (window - 1, 0)
    needed = window if min_periods is None else min_periods

    def make(spec: WindowSpec) -> Column:
        frame = spec.rowsBetween(-before, after)
        return F.when(F.count(value).over(frame) >= needed, F.avg(value).over(frame))

    return over_rows(df, keys, order_by, {name: make}, before, after, **options)


def shift_rows(
    df: DataFrame, value: str, order_by: str | Column | Order, periods: int, keys: Sequence[str] = (),
    name: str = "shifted", **options,
) -> DataFrame:
    """Value ``periods`` rows earlier (positive) or later (negative) inside the key group."""

    def make(spec: WindowSpec) -> Column:
        return F.lag(value, periods).over(spec) if periods >= 0 else F.lead(value, -periods).over(spec)

    return over_rows(df, keys, order_by, {name: make}, max(periods, 0), max(-periods, 0), **options)


def drop_last(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """All rows but the last ``n`` of an ascending order, by position: of tied rows just as many go as needed."""
    placed = with_position(df, order_by, "__pos")
    total = placed.agg(F.count(F.lit(1))).scalar()
    return placed.where(F.col("__pos") < total - n).drop("__pos")


def zip_by_order(left: DataFrame, right: DataFrame, left_order: Order, right_order: Order) -> DataFrame:
    """Put two frames side by side by their position in explicit orders; the longer one keeps its rows."""
    lhs = with_position(left, left_order, "position")
    rhs = with_position(right, right_order, "position")
    return lhs.join(rhs, "position", "full")
