"""Constraint audits: what a declared schema would refuse, as (table, constraint, key, n) rows."""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str


@dataclass(frozen=True)
class Table:
    """A declared table: columns with types, and what must hold for them."""

    name: str
    columns: dict[str, T.DataType]
    primary_key: tuple[str, ...]
    unique_not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t) for c, t in self.columns.items()])


def _line(df: DataFrame, table: str, constraint: str, key: Column, n: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("table"), F.lit(constraint).alias("constraint"), key.alias("key"), n.cast("bigint").alias("n")
    )


def _text(columns: tuple[str, ...]) -> Column:
    """Key columns as one text, NULL parts written out."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


def unique_not_null(df: DataFrame, table: str, columns: tuple[str, ...], kind: str) -> DataFrame:
    """Keys that are NULL or occur more than once, with their number of rows."""
    missing = functools.reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    bad = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(missing | (F.col("n") > 1))
    return _line(bad, table, f"{kind}({','.join(columns)})", _text(columns), F.col("n"))


def primary_key(df: DataFrame, table: str, *columns: str) -> DataFrame:
    return unique_not_null(df, table, columns, "primary key")


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    return unique_not_null(df, table, (column,), "unique not null")


@dataclass(frozen=True)
class Reference:
    """A foreign key between two of the tables under audit."""

    table: str
    column: str
    parent: str
    key: str

    @property
    def constraint(self) -> str:
        return f"foreign key({self.column})->{self.parent}({self.key})"


def references(tables: dict[str, DataFrame], keys: list[Reference]) -> DataFrame:
    """Values without a parent row, with their number of rows; NULL is allowed.

    Every table is read once, whatever number of constraints it takes part in: its values go out under the parent
    keys they are or should be, are counted per value before anything meets, and a value is dangling if no row of the
    parent came along with it.
    """
    parts = []
    for name in dict.fromkeys(n for k in keys for n in (k.table, k.parent)):
        cells = [(f"{k.parent}.{k.key}", k.table, k.constraint, k.column) for k in keys if k.table == name]
        owned = dict.fromkeys(k.key for k in keys if k.parent == name)
        cells += [(f"{name}.{key}", None, None, key) for key in owned]
        rows = F.array(
            *[
                F.struct(
                    F.lit(target).alias("target"),
                    F.lit(table).cast("string").alias("table"),
                    F.lit(constraint).cast("string").alias("constraint"),
                    F.col(column).cast("string").alias("value"),
                )
                for target, table, constraint, column in cells
            ]
        )
        parts.append(tables[name].select(F.inline(rows)).where("value is not null"))
    counted = union_all(parts).groupBy("target", "value", "table", "constraint").agg(F.count(F.lit(1)).alias("n"))
    met = counted.groupBy("target", "value").agg(
        F.max(F.col("table").isNull()).alias("known"),
        F.collect_list(F.when(F.col("table").isNotNull(), F.struct("table", "constraint", "n"))).alias("uses"),
    )
    return met.where("not known").select(F.inline("uses"), "value").select("table", "constraint", F.col("value").alias("key"), "n")


def bad_values(df: DataFrame, table: str, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """Rows (constraint, key, whether it is violated) of all checks of a table, counted in one scan."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("constraint"), key.cast("string").alias("key"), bad.alias("bad")) for c, key, bad in checks]
    )
    found = df.select(F.inline(cells)).where("bad").groupBy("constraint", "key").agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.lit(table).alias("table"), "constraint", "key", "n")


def too_long(column: str, limit: int) -> tuple[str, Column, Column]:
    """Texts longer than declared, counted per length."""
    return f"varchar({limit}) {column}", F.length(column), F.length(column) > limit


def not_castable(column: str, to: T.DataType) -> tuple[str, Column, Column]:
    """Values a declared type cannot hold. A decimal must also keep every digit."""
    value = F.col(column)
    made = value.try_cast(to)
    bad = made.isNull()
    if isinstance(to, T.DecimalType):
        wide = value.try_cast(T.DecimalType(38, 18))
        bad = bad | wide.isNull() | (made.cast(T.DecimalType(38, 18)) != wide)
    return f"{to.simpleString()} {column}", value, value.isNotNull() & bad


def union_all(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def audit_foreign_keys(tables: dict[str, DataFrame], specs: list[Table]) -> DataFrame:
    return references(tables, declared_references(specs))


def declared_references(specs: list[Table]) -> list[Reference]:
    return [Reference(s.name, fk.column, fk.table, fk.key) for s in specs for fk in s.foreign_keys]


def audit_primary_keys(tables: dict[str, DataFrame], specs: list[Table]) -> DataFrame:
    return union_all([primary_key(tables[s.name], s.name, *s.primary_key) for s in specs])


def audit_unique(tables: dict[str, DataFrame], specs: list[Table]) -> DataFrame:
    return union_all([unique(tables[s.name], s.name, c) for s in specs for c in s.unique_not_null])


def audit_lengths(tables: dict[str, DataFrame], specs: list[Table]) -> DataFrame:
    checks = {s.name: [too_long(c, n) for c, n in s.max_length.items()] for s in specs}
    return union_all([bad_values(tables[name], name, own) for name, own in checks.items() if own])


def audit_types(tables: dict[str, DataFrame], specs: list[Table], *kinds: type[T.DataType]) -> DataFrame:
    """Text columns that cannot take their declared type, for the given kinds of type."""
    checks = {s.name: [not_castable(c, t) for c, t in s.columns.items() if isinstance(t, kinds)] for s in specs}
    return union_all([bad_values(tables[name], name, own) for name, own in checks.items() if own])


def audit_all(tables: dict[str, DataFrame], specs: list[Table]) -> DataFrame:
    kinds = (T.IntegerType, T.DateType, T.BooleanType, T.DecimalType)
    return union_all(
        [
            audit_primary_keys(tables, specs),
            audit_unique(tables, specs),
            audit_foreign_keys(tables, specs),
            audit_lengths(tables, specs),
            audit_types(tables, specs, *kinds),
        ]
    )
