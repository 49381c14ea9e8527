"""A model: named tables, foreign keys between them, and queries that join along those keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def column_names(spark: SparkSession, expression: str) -> list[tuple[str, ...]]:
    """Name parts of the columns an SQL expression refers to, as Spark's own parser reads them."""
    parsed = spark._jsparkSession.sessionState().sqlParser().parseExpression(expression)
    leaves = parsed.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "UnresolvedAttribute":
            parts = leaf.nameParts()
            found.append(tuple(parts.apply(j) for j in range(parts.size())))
    return found


@dataclass(frozen=True)
class ForeignKey:
    """Many-to-one link: every ``source`` row points to at most one ``target`` row."""

    source: str
    target: str
    columns: tuple[tuple[str, str], ...]


@dataclass(frozen=True)
class ProcessConfiguration:
    """Which table and columns form the event log of a model."""

    activity_table: str
    case_column: str
    activity_column: str
    timestamp_column: str
    sorting_column: str | None = None
    case_table: str | None = None


@dataclass(frozen=True)
class ModelQuery:
    """An immutable query over a model; extending it returns a new query."""

    model: Model
    dims: Mapping[str, str] = field(default_factory=dict)
    measures: Mapping[str, str] = field(default_factory=dict)
    filters: tuple[str, ...] = ()
    order: tuple[tuple[str, str], ...] = ()
    distinct: bool = False
    row_limit: int | None = None
    row_offset: int | None = None
    via: Mapping[str, str] = field(default_factory=dict)
    repeated_rows_ok: bool = False

    def with_dim(self, name: str, expression: str) -> ModelQuery:
        return replace(self, dims={**self.dims, name: expression})

    def with_measure(self, name: str, expression: str) -> ModelQuery:
        return replace(self, measures={**self.measures, name: expression})

    def where(self, *conditions: str) -> ModelQuery:
        return replace(self, filters=(*self.filters, *conditions))

    def to_df(self) -> DataFrame:
        """One lazy DataFrame: only mentioned tables are joined, filters and columns reach their scans."""
        model = self.model
        texts = [*self.dims.values(), *self.measures.values(), *self.filters]
        mentioned = set().union(*(model.tables_in(text) for text in texts)) if texts else set()
        root, joins = model.join_tree(mentioned, self.via)
        if self.measures and not self.repeated_rows_ok:
            for name, text in self.measures.items():
                foreign = model.tables_in(text) - {root}
                if foreign:
                    raise ValueError(f"measure {name!r} uses {sorted(foreign)}, whose rows repeat per row of {root!r}")
        df = model.tables[root].alias(root)
        for key in joins:
            on = [F.col(f"{key.source}.{a}") == F.col(f"{key.target}.{b}") for a, b in key.columns]
            df = df.join(model.tables[key.target].alias(key.target), on, "left")
        for condition in self.filters:
            df = df.where(condition)
        dims = [F.expr(text).alias(name) for name, text in self.dims.items()]
        measures = [F.expr(text).alias(name) for name, text in self.measures.items()]
        if measures:
            df = df.groupBy(*dims).agg(*measures) if dims else df.agg(*measures)
        else:
            df = df.select(*dims)
        if self.distinct:
            df = df.distinct()
        if self.order:
            df = df.orderBy(*[
                F.col(f"`{name}`").desc_nulls_last() if direction.lower() == "desc" else F.col(f"`{name}`").asc_nulls_last()
                for name, direction in self.order
            ])
        if self.row_offset is not None:
            df = df.offset(self.row_offset)
        if self.row_limit is not None:
            df = df.limit(self.row_limit)
        return df


class Model:
    """Tables by name plus declared foreign keys. Holds lazy DataFrames only."""

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        keys: Sequence[ForeignKey] = (),
        process: ProcessConfiguration | None = None,
    ):
        self.tables = dict(tables)
        self.keys: list[ForeignKey] = []
        self.process = process
        self.saved: dict[str, ModelQuery] = {}
        for key in keys:
            self.add_key(key)

    def add_table(self, name: str, df: DataFrame) -> None:
        if name in self.tables:
            raise ValueError(f"table {name!r} is already in the model")
        self.tables[name] = df

    def add_key(self, key: ForeignKey) -> None:
        for table, columns in ((key.source, [a for a, _ in key.columns]), (key.target, [b for _, b in key.columns])):
            if table not in self.tables:
                raise ValueError(f"foreign key names unknown table {table!r}")
            missing = set(columns) - set(self.tables[table].columns)
            if missing:
                raise ValueError(f"{table!r} has no columns {sorted(missing)}")
        if key not in self.keys:
            self.keys.append(key)

    def table(self, name: str) -> DataFrame:
        """Whole-table scan."""
        return self.tables[name]

    def query(
        self,
        dims: Mapping[str, str] | None = None,
        measures: Mapping[str, str] | None = None,
        where: Sequence[str] = (),
        order: Sequence[tuple[str, str]] = (),
        distinct: bool = False,
        limit: int | None = None,
        offset: int | None = None,
        via: Mapping[str, str] | None = None,
        repeated_rows_ok: bool = False,
    ) -> ModelQuery:
        """Named Spark SQL expressions over ``table.column`` names; measures are grouped by the dims.

        ``via`` names, for a table that several key paths reach, the table it must be joined from.
        """
        if (limit is not None or offset is not None) and not order:
            raise ValueError("limit and offset need an order")
        return ModelQuery(
            self, dict(dims or {}), dict(measures or {}), tuple(where), tuple(order), distinct, limit, offset,
            dict(via or {}), repeated_rows_ok,
        )

    def save(self, name: str, query: ModelQuery) -> None:
        """Keep a query under a name and expose it as a temporary view."""
        self.saved[name] = query
        query.to_df().createOrReplaceTempView(name)

    def tables_in(self, expression: str) -> set[str]:
        """Model tables whose columns an expression mentions.

        A name may be ``table.column``, with fields of the column behind it, or a column that only one table has. Other
        names, such as the variables of lambda functions, belong to no table.
        """
        found: set[str] = set()
        for first, *rest in column_names(next(iter(self.tables.values())).sparkSession, expression):
            if rest and first in self.tables:
                if rest[0] not in self.tables[first].columns:
                    raise ValueError(f"{first!r} has no column {rest[0]!r}")
                found.add(first)
            else:
                owners = [t for t, df in self.tables.items() if first in df.columns]
                if len(owners) > 1:
                    raise ValueError(f"column {first!r} is in several tables {owners}: qualify it")
                found.update(owners)
        return found

    def join_tree(self, mentioned: set[str], via: Mapping[str, str]) -> tuple[str, list[ForeignKey]]:
        """The many-side table and the keys that lead from it to every other mentioned table."""
        if not mentioned:
            raise ValueError("the query mentions no table of the model")
        roots = [t for t in mentioned if all(self._paths(t, other, via) for other in mentioned)]
        if len(roots) != 1:
            raise ValueError(f"no single table reaches all of {sorted(mentioned)} along foreign keys")
        root = roots[0]
        chosen: dict[str, ForeignKey] = {}
        for other in sorted(mentioned - {root}):
            paths = self._paths(root, other, via)
            if len(paths) > 1:
                routes = [[k.source for k in p] for p in paths]
                raise ValueError(f"{other!r} is reached from {root!r} in several ways {routes}: name one with via=")
            for key in paths[0]:
                if chosen.setdefault(key.target, key) != key:
                    raise ValueError(f"{key.target!r} would be joined twice: split the query or name via=")
        ordered: list[ForeignKey] = []
        reached = {root}
        while len(ordered) < len(chosen):
            ready = [k for k in chosen.values() if k.source in reached and k.target not in reached]
            ordered += ready
            reached |= {k.target for k in ready}
        return root, ordered

    def _paths(self, start: str, end: str, via: Mapping[str, str], seen: tuple[str, ...] = ()) -> list[list[ForeignKey]]:
        if start == end:
            return [[]]
        found = []
        for key in self.keys:
            if key.source != start or key.target in seen or via.get(key.target, start) != start:
                continue
            found += [[key, *rest] for rest in self._paths(key.target, end, via, (*seen, start))]
        return found

    def check_keys(self) -> DataFrame:
        """Per foreign key: rows without a partner and target keys that are not unique."""
        reports = []
        for key in self.keys:
            source, target = self.tables[key.source], self.tables[key.target]
            on = [source[a] == target[b] for a, b in key.columns]
            orphans = source.dropna(subset=[a for a, _ in key.columns]).join(target, on, "left_anti")
            repeated = target.groupBy(*[b for _, b in key.columns]).count().where("count > 1")
            reports.append(
                orphans.agg(F.count(F.lit(1)).alias("orphans")).select(
                    F.lit(key.source).alias("source"), F.lit(key.target).alias("target"), "orphans",
                    repeated.agg(F.count(F.lit(1)).alias("n")).scalar().alias("repeated_keys"),
                )
            )
        result = reports[0]
        for report in reports[1:]:
            result = result.unionByName(report)
        return result

    def rebind(self, spark: SparkSession, database: str, registry: dict[str, Model], name: str) -> Model:
        """The same definition over same-named tables of another database; definitions move, data does not."""
        if name in registry:
            raise ValueError(f"model {name!r} already exists")
        missing = [t for t in self.tables if not spark.catalog.tableExists(f"{database}.{t}")]
        if missing:
            raise ValueError(f"{database!r} lacks the tables {missing}")
        bound = Model({t: spark.table(f"{database}.{t}") for t in self.tables}, self.keys, self.process)
        registry[name] = bound
        return bound


def list_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database))


def find_table(spark: SparkSession, name: str, database: str | None = None, partial: bool = False) -> DataFrame:
    """The one table with this name, or with this text in its name; none or several hits are an error."""
    names = list_tables(spark, database)
    hits = [n for n in names if n == name] or ([n for n in names if name in n] if partial else [])
    if len(hits) != 1:
        raise LookupError(f"{name!r} matches {hits or 'no table'}")
    return spark.table(f"{database}.{hits[0]}" if database else hits[0])
