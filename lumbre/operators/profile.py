"""Column profiles: counts, distinct values, distributions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.operators import entities, quantiles
from lumbre.session import fine_parts
from lumbre.sources.tables import save_scratch, scratch


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns of a frame as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def count_where(df: DataFrame, **conditions: Column) -> DataFrame:
    """How many rows meet each named condition, in one pass."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def column_types(df: DataFrame) -> DataFrame:
    """(column, dtype, n_rows, non_null) per column."""
    stats = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    each = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"), F.col(f.name).alias("non_null"))
            for f in df.schema
        ]
    )
    return stats.select("n_rows", F.explode(each).alias("c")).select("c.column", "c.dtype", "n_rows", "c.non_null")


def _countable(df: DataFrame, column: str) -> Column:
    """The column with NaN as missing, as the other profiles have it."""
    value = F.col(column)
    return F.nanvl(value, F.lit(None)) if isinstance(df.schema[column].dataType, T.FractionalType) else value


def _as_rows(stats: DataFrame, columns: list[str], name: str) -> DataFrame:
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(name)) for c in columns])
    return stats.select(F.explode(each).alias("x")).select("x.column", f"x.{name}")


def distinct_per_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-missing values per column: (column, n_distinct).

    Spark makes (column, value) pairs distinct before and after the shuffle, so a value that fills
    a third of a column costs one row per task.
    """
    return _as_rows(df.agg(*[F.count_distinct(_countable(df, c)).alias(c) for c in columns]), columns, "n_distinct")


def distinct_per_group(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Largest number of distinct values any group shows, per column: (column, max_distinct). Runs at once.

    A group of one row shows one value or none, which a plain maximum tells; only rows of groups with several are
    dealt out by column and value, where each takes as many rows as there are columns.
    """
    with scratch(df.sparkSession) as scope:
        rows = save_scratch(df.select(by, *[_countable(df, c).alias(c) for c in columns]), "grouped")
        single = rows.agg(*[F.max(F.col(c).isNotNull().cast("bigint")).alias(c) for c in columns])
        per_group = entities.duplicated(rows, [by]).groupBy(by).agg(*[F.count_distinct(c).alias(c) for c in columns])
        most = single.unionByName(per_group.agg(*[F.max(c).alias(c) for c in columns])).agg(*[F.max(c).alias(c) for c in columns])
        return scope.keep(_as_rows(save_scratch(most, "most-distinct"), columns, "max_distinct"))


def elements(df: DataFrame, column: str) -> DataFrame:
    """Distinct members of an array column: (member)."""
    return df.select(F.explode(column).alias("member")).where("member is not null").distinct()


def distinct_sets(df: DataFrame, column: str) -> DataFrame:
    """Number of different sets, whatever the order of their members."""
    as_set = F.array_sort(F.array_distinct(column))
    return df.select(as_set.alias("s")).distinct().agg(F.count("s").alias("n_sets"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Frequency per non-NULL value: (value, n)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def value_counts_exploded(df: DataFrame, column: str) -> DataFrame:
    """Frequency per array member: (value, n)."""
    return value_counts(df.select(F.explode(column).alias("value")), "value")


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(df, column).orderBy(F.desc("n"), "value").limit(k)


def _number_stats(df: DataFrame, columns: list[str], stats: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """One row per column with the named aggregates, from one pass that does not multiply the rows."""
    named = {f"{name}_{i}": fn(_countable(df, c).cast("double")) for i, c in enumerate(columns) for name, fn in stats.items()}
    each = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in stats])
        for i, c in enumerate(columns)
    ]
    wide = df.agg(*[expr.alias(name) for name, expr in named.items()])
    return wide.select(F.explode(F.array(*each)).alias("x")).select("x.*")


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _measured(df: DataFrame, columns: list[str], stats: dict, named: dict[str, float], order: list[str]) -> DataFrame:
    """Aggregates and quantiles per column, both from the same two scans."""
    found = quantiles.measured(df, columns, list(named.values()), stats)
    types = ["column string", *[f"{c} {'bigint' if c == 'count' else 'double'}" for c in order]]
    rows = [{**m, **{name: m["p"].get(float(p)) for name, p in named.items()}} for m in found]
    return df.sparkSession.createDataFrame([tuple(r[c] for c in ("column", *order)) for r in rows], ", ".join(types))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max: one row per column, from two scans. Runs at once."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return _measured(df, columns, stats, QUARTILES, ["count", "mean", "std", "min", *QUARTILES, "max"])


def mean_std_median(df: DataFrame, columns: list[str]) -> DataFrame:
    return _measured(df, columns, {"mean": F.avg, "std": F.stddev_samp}, {"median": 0.5}, ["mean", "std", "median"])


def histogram(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """Equal-width bins over each column's range: (column, bin, lo, hi, n), empty bins included.

    The last bin is closed. A constant column is put in the middle of a range of width one.
    """
    long = quantiles.melt(df, columns)
    # one row per column: as small as the column list
    extremes = _number_stats(df, columns, {"least": F.min, "most": F.max}).where("least is not null")
    flat = F.when(F.col("least") == F.col("most"), 0.5).otherwise(0.0)
    ranges = extremes.select("column", (F.col("least") - flat).alias("lo"), (F.col("most") + flat).alias("hi"))
    bin_of = F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = (
        long.join(F.broadcast(ranges), "column")
        .groupBy("column", bin_of.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1)))).select(
        "column", "bin", (F.col("lo") + width * F.col("bin")).alias("lo"), (F.col("lo") + width * (F.col("bin") + 1)).alias("hi")
    )
    return frame.join(counts, ["column", "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def box_stats(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """Box-plot numbers per group and column: quartiles, whisker ends, rows outside the whiskers.

    Whiskers end at the outermost value within 1.5 interquartile ranges of the box. Values are counted into cells with
    their ends; a cell wholly inside or outside the whiskers' reach is settled by these, and only the rows of the cells
    that a bound cuts, two a group at most, are read again. No row is joined to its box.
    """
    present, group = df.where(F.col(by).isNotNull()), [by, "column"]
    with scratch(df.sparkSession) as scope:
        cells = quantiles.celled(present, columns, [by])
        rows, counted = cells
        boxes = save_scratch(quantiles.exact_wide(present, columns, QUARTILES, [by], cells), "boxes")
        reach = (F.col("q75") - F.col("q25")) * 1.5
        bounds = boxes.select(*group, (F.col("q25") - reach).alias("least"), (F.col("q75") + reach).alias("most"))
        placed = save_scratch(counted.join(bounds, group), "placed-cells")
        inside, outside = F.expr("lo >= least and hi <= most"), F.expr("hi < least or lo > most")
        settled = placed.groupBy(*group).agg(
            F.sum("n").alias("n"),
            F.min(F.when(inside, F.col("lo"))).alias("lo"),
            F.max(F.when(inside, F.col("hi"))).alias("hi"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("out"),
        )
        cut = save_scratch(placed.where(~(inside | outside)).select(*group, "cell", "least", "most"), "cut-cells")
        value = F.col("value")
        within = value.between(F.col("least"), F.col("most"))
        again = rows.join(cut, [*group, "cell"]).groupBy(*group).agg(
            F.lit(0).cast("bigint").alias("n"),
            F.min(F.when(within, value)).alias("lo"),
            F.max(F.when(within, value)).alias("hi"),
            F.count_if(~within).alias("out"),
        )
        ends = settled.unionByName(again).groupBy(*group).agg(
            F.sum("n").alias("n"), F.min("lo").alias("whisker_lo"), F.max("hi").alias("whisker_hi"), F.sum("out").alias("n_outliers")
        )
        out = ends.join(boxes, group).select(*group, "n", *QUARTILES, "whisker_lo", "whisker_hi", "n_outliers")
        return scope.keep(out)


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson correlation per pair of columns: (x, y, r), all from one pass."""
    stats = df.agg(*[F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    each = F.array(
        *[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")) for i, (x, y) in enumerate(pairs)]
    )
    return stats.select(F.explode(each).alias("p")).select("p.x", "p.y", "p.r")


def inside_quantiles(df: DataFrame, columns: list[str], low: float, high: float) -> DataFrame:
    """Rows whose every named column lies between its own two quantiles, ends included."""
    bounds = {b["column"]: b for b in quantiles.exact_wide(df, columns, {"lo": low, "hi": high}).collect()}
    for c in columns:
        # one pair of constants per column, so the filter reaches the scan
        df = df.where(F.col(c).between(bounds[c]["lo"], bounds[c]["hi"])) if c in bounds else df.where(F.lit(False))
    return df


def unique_check(df: DataFrame, key: str) -> DataFrame:
    """(n_rows, n_keys, is_unique): a NULL key counts as a key.

    Counted here and now, in small parts: all keys of a part are in its task's memory, once for each grouping by them.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.max("n") == 1, F.lit(True)).alias("is_unique"),
    )
    with fine_parts(df.sparkSession):
        return save_scratch(found, "unique")


#: Buckets that two frames are compared by; their list may be broadcast.
DIGESTS = 4096


def _bucketed(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("_hash", F.xxhash64(*columns)).withColumn("_bucket", F.pmod("_hash", F.lit(DIGESTS)).cast("int"))


def _digests(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per bucket of rows: their number, and sums and exclusive ors of two hashes, whatever the order of rows."""
    other = F.xxhash64(F.lit(1), *columns)
    parts = [F.col("_hash").bitwiseAND(0xFFFFFFFF), F.shiftright("_hash", 32), other.bitwiseAND(0xFFFFFFFF), F.shiftright(other, 32)]
    sums = [F.sum(p.cast("decimal(20,0)")) for p in parts]
    return _bucketed(df, columns).groupBy("_bucket").agg(
        F.struct(F.count(F.lit(1)), F.bit_xor("_hash"), F.bit_xor(other), *sums).alias("digest")
    )


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """(_bucket) of those buckets whose rows are not the same on both sides: at most ``DIGESTS`` rows.

    Unequal buckets pass for equal with a chance of about 2 ** -128.
    """
    a, b = (_digests(df, left.columns).alias(name) for df, name in ((left, "a"), (right, "b")))
    same = F.col("a.digest").eqNullSafe(F.col("b.digest"))
    both = a.join(b, F.col("a._bucket") == F.col("b._bucket"), "full").where(~same)
    return both.select(F.coalesce("a._bucket", "b._bucket").alias("_bucket"))


def frames_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus of the left side; none if equal.

    Both sides are first compared by digests of buckets of rows, made without a shuffle of the rows; only rows of
    buckets that differ are then counted one by one.
    """
    columns = left.columns
    schema = left.unionByName(right).schema
    left, right = (df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]) for df in (left, right))
    differing = F.broadcast(differing_buckets(left, right))
    signed = _bucketed(left, columns).withColumn("surplus", F.lit(1)).unionByName(_bucketed(right, columns).withColumn("surplus", F.lit(-1)))
    rows = signed.join(differing, "_bucket", "left_semi")
    return rows.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")


def frames_equal(left: DataFrame, right: DataFrame) -> bool:
    return frames_difference(left, right).isEmpty()


def text_lengths(df: DataFrame, columns: list[str]) -> DataFrame:
    """Character counts under ``<column>_length``."""
    return df.select(*[F.length(c).alias(f"{c}_length") for c in columns])


def head(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def tail(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)
