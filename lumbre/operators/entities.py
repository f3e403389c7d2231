"""Duplicate entities: marking, first-row selection, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbre.functions import sets
from lumbre.operators.joins import null_safe


def with_ordinal(df: DataFrame, name: str = "ord") -> DataFrame:
    """Input order of a file scan as a sortable column: file, block, row within the block.

    Take it straight after the read, before anything moves rows.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(name),
    )


def duplicated(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once; NULL keys equal each other.

    Keys are counted first (combined before the shuffle), then rows are matched with the repeated
    ones. No window gathers the rows of a frequent key, and the skewed side of the semi join can be
    split at run time.
    """
    repeated = df.groupBy(*keys).count().where("count > 1").select(*keys)
    return df.join(repeated, null_safe(df, repeated, keys), "left_semi")


def keep_first(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row per key in the given order. The rank limit is applied before the shuffle too."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def union_of_sets(df: DataFrame, key: str, column: str) -> DataFrame:
    """Union of the array members per key: (key, column). Members are made distinct map-side."""
    members = df.select(key, F.explode_outer(column).alias("_member"))
    return members.groupBy(key).agg(F.array_sort(F.collect_set("_member")).alias(column))


def rounded_mean(column: str | Column) -> Column:
    """Aggregate: mean rounded half to even, as a whole number."""
    return F.rint(F.avg(column)).cast("bigint")


def merge_duplicates(df: DataFrame, key: str, order: str, unions: str, means: list[str]) -> DataFrame:
    """One row per key: the union of the set column, the rounded mean of the metrics, and everything
    else from the first row.

    A single aggregation: each row is sent once as a whole, with the first of its set members, and once per further
    member as a slim row of key and member. What a task holds per key is one row and the key's distinct members, which is
    the result itself, so a key with very many copies is no problem.
    """
    rest = [c for c in df.columns if c not in (key, order, unions, *means)]
    none = F.array(F.lit(None)).cast(df.schema[unions].dataType)
    members = F.when(F.size(unions) > 0, F.col(unions)).otherwise(none)
    placed = F.arrays_zip(F.sequence(F.lit(0), F.size(members) - 1).alias("_at"), members.alias("_member"))
    rows = df.select(key, order, *rest, *means, F.inline(placed))
    whole = F.col("_at") == 0
    merged = rows.groupBy(key).agg(
        F.min(F.when(whole, F.struct(order, *rest))).alias("_first"),
        F.array_sort(F.collect_set("_member")).alias(unions),
        *[rounded_mean(F.when(whole, F.col(m))).alias(m) for m in means],
    )
    columns = {key, unions, *means}
    return merged.select(
        *[F.col(c) if c in columns else F.col("_first")[c].alias(c) for c in df.columns]
    )


def parse_sets(df: DataFrame, *columns: str) -> DataFrame:
    """Text columns as sets: the members of a list or set literal; text that is neither is one member."""

    def parsed(text: Column) -> Column:
        return F.when(text.isNull(), sets.to_set(F.array())).otherwise(
            sets.to_set(F.coalesce(sets.parse_list_literal(text), F.array(text)))
        )

    return df.withColumns({c: parsed(F.col(c)) for c in columns})
