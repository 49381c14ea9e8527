"""Event-log operators: order, variants and throughput of cases.

A case may be arbitrarily long. Numbering goes through the size-checked ordered operators, variant texts are cut
into parts of bounded length, and variants are compared by order-sensitive hashes that combine map-side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.ordered import GROUP_ROWS, with_group_position, with_position
from caseloom.session import materialize

PART_EVENTS = 10_000


@dataclass(frozen=True)
class EventLog:
    """A table bound to its case, activity, time and optional tie-breaking columns."""

    df: DataFrame
    case: Sequence[str] | str
    activity: str
    ts: str
    sort: str | None = None

    @property
    def case_columns(self) -> list[str]:
        return [self.case] if isinstance(self.case, str) else list(self.case)

    @property
    def order(self) -> list[str]:
        return [self.ts, *([self.sort] if self.sort else [])]


def event_order(log: EventLog, name: str = "position", group_rows: int = GROUP_ROWS) -> DataFrame:
    """1-based position of each event in its case, by time then sorting column."""
    return with_group_position(log.df, log.case_columns, log.order, name, group_rows)


def ordered_text(df: DataFrame, keys: Sequence[str], position: str, text: Column, sep: str, part_rows: int, name: str) -> DataFrame:
    """Texts of a group joined in position order, as consecutive parts of at most ``part_rows`` rows."""
    part = F.floor((F.col(position) - 1) / part_rows).cast("bigint").alias("part")
    cells = F.sort_array(F.collect_list(F.struct(F.col(position).alias("p"), text.alias("t"))))
    grouped = df.groupBy(*keys, part).agg(cells.alias("__cells"))
    return grouped.select(*keys, "part", F.array_join(F.col("__cells.t"), sep).alias(name))


def _narrow_order(log: EventLog, group_rows: int) -> DataFrame:
    """Case, position and activity of every event, written once for the passes that follow."""
    ordered = event_order(log, "__pos", group_rows).select(*log.case_columns, "__pos", F.col(log.activity).alias("__act"))
    return materialize(ordered, "order")


def _texts(ordered: DataFrame, cases: Sequence[str], sep: str, part_events: int) -> DataFrame:
    return ordered_text(ordered, cases, "__pos", F.col("__act"), sep, part_events, "variant")


def _identities(ordered: DataFrame, cases: Sequence[str]) -> DataFrame:
    """Length and two 64-bit order-sensitive hashes per case: equal for equal activity sequences."""
    return ordered.groupBy(*cases).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.bit_xor(F.xxhash64("__pos", "__act")).alias("__h1"),
        F.bit_xor(F.xxhash64("__act", "__pos", F.lit("second"))).alias("__h2"),
    )


IDENTITY = ("n_events", "__h1", "__h2")


def case_variants(log: EventLog, sep: str = " > ", part_events: int = PART_EVENTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The ordered activities of each case; cases longer than ``part_events`` take several parts."""
    ordered = event_order(log, "__pos", group_rows).withColumn("__act", F.col(log.activity))
    return _texts(ordered, log.case_columns, sep, part_events)


def variant_counts(log: EventLog, sep: str = " > ", part_events: int = PART_EVENTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Cases per variant, most frequent first, with the variant's text taken from one of its cases.

    Only the texts of these cases are built.
    """
    ordered = _narrow_order(log, group_rows)
    counted = _identities(ordered, log.case_columns).groupBy(*IDENTITY).agg(
        F.count(F.lit(1)).alias("n_cases"), F.min(F.struct(*log.case_columns)).alias("__case")
    )
    chosen = counted.select("n_events", "n_cases", "__case.*")
    texts = _texts(ordered.join(chosen, log.case_columns, "left_semi"), log.case_columns, sep, part_events)
    return texts.join(chosen, log.case_columns).select("variant", "part", "n_events", "n_cases").orderBy(
        F.desc("n_cases"), "variant", "part"
    )


def variant_codes(log: EventLog, name: str = "variant_code", part_events: int = PART_EVENTS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """0-based code of each case's variant, in the order of the variant texts, whole texts of any length.

    Variants are compared part by part. Parts of ``part_events`` activities are ranked by their text once; from then on ranks
    of neighbouring parts are ranked as pairs, so that a rank covers 1, 2, 4, ... parts, until one rank stands for a whole
    variant. Texts are never joined beyond a part, and every round sorts two numbers for half as many rows. The order
    is the same for any size of parts, if no name holds the separator: every part but the last of a variant ends with it, and a
    variant that ends sorts before one that goes on.
    """
    ordered = _narrow_order(log, group_rows)
    cases = _identities(ordered, log.case_columns)
    chosen = materialize(
        cases.groupBy(*IDENTITY).agg(F.min(F.struct(*log.case_columns)).alias("__case")).select(*IDENTITY, "__case.*"), "chosen")
    sep = " > "
    events = ordered.join(chosen, log.case_columns).select(*IDENTITY, "__pos", F.concat("__act", F.when(F.col("__pos") < F.col("n_events"), sep).otherwise("")).alias("__text"))
    parts = ordered_text(events, IDENTITY, "__pos", F.col("__text"), "", part_events, "__text")
    ranked = materialize(_dense_rank(parts, ["__text"], "__rank").select(*IDENTITY, "part", "__rank"), "ranks")
    last = ranked.agg(F.max("part")).first()[0] or 0
    while last > 0:
        half = F.floor(F.col("part") / 2).cast("bigint").alias("part")
        first, second = (F.max(F.when(F.col("part") % 2 == i, F.col("__rank"))) for i in (0, 1))
        pairs = ranked.groupBy(*IDENTITY, half).agg(first.alias("__first"), F.coalesce(second, F.lit(-1)).alias("__second"))
        ranked = materialize(_dense_rank(pairs, ["__first", "__second"], "__rank").select(*IDENTITY, "part", "__rank"), "ranks")
        last //= 2
    # Names that hold the separator can give two variants one text; these keep their own codes, ordered by hash.
    codes = with_position(ranked.select("__rank", *IDENTITY), ["__rank", *IDENTITY], name).select(*IDENTITY, name)
    return cases.join(codes, list(IDENTITY)).select(*log.case_columns, name)


def _dense_rank(df: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """0-based rank of the distinct values of ``by``, numbered by a distributed sort."""
    return df.join(with_position(df.select(*by).distinct(), list(by), name), list(by))


def throughput_days(log: EventLog, name: str = "throughput_days") -> DataFrame:
    """Days between the first and last event of each case."""
    spans = log.df.groupBy(*log.case_columns).agg(F.min(log.ts).alias("first_ts"), F.max(log.ts).alias("last_ts"))
    seconds = F.timestamp_diff("SECOND", F.col("first_ts"), F.col("last_ts"))
    return spans.withColumn(name, seconds / F.lit(86400.0))
