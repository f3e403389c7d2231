"""Exact quantiles that never bring a large column's values together in one task.

Spark's ``percentile`` keeps every distinct value of a group in one task. Over whole columns, a mergeable sketch in
the first scan names two values between which each wanted rank must lie; the second scan counts what is below them and
keeps only what is inside, a few thousandths of the rows, among which the rank is found. Should a rank not lie between
its two values after all, the second way settles it: values are counted into cells, the few cells holding the wanted
ranks are split finer, and only the values of a finest cell are ranked one by one. Groups always go that way, as a
sketch per group would be as large as a small group itself.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.sources.tables import save_scratch, scratch

_COARSE = 1024
_FINE = 4096
_START = Window.unboundedPreceding
#: The sketch's ranks are off by a share of 1 / ACCURACY at most; brackets reach twice as far ...
ACCURACY = 10_000
#: ... or this far, where that is less than two rows; with fewer rows still they reach from end to end.
WIDE = 0.02
#: Different values of a bracket that one task ranks; a larger bracket is cut into cells first.
ONE_TASK = 1_000_000


def melt(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Long form (by ..., column, value): one row per non-missing number."""
    by = by or []
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot(by, columns, "column", "value") if len(columns) > 1 else wide.select(
        *by, F.lit(columns[0]).alias("column"), F.col(columns[0]).alias("value")
    )
    return long.where(F.col("value").isNotNull() & ~F.isnan("value"))


def number(df: DataFrame, column: str) -> Column:
    """A column as a double, with NaN as missing."""
    value = F.col(column)
    kept = F.nanvl(value, F.lit(None)) if isinstance(df.schema[column].dataType, T.FractionalType) else value
    return kept.cast("double")


# ---------------------------------------------------------------- whole columns: brackets from a sketch


@dataclass
class _Brackets:
    """The two values around each wanted rank of a column, and what the second scan found."""

    ranks: list[int]
    pairs: list[tuple[float, float]]

    def __post_init__(self) -> None:
        self.points = sorted({x for pair in self.pairs for x in pair})

    def wanted(self) -> list[int]:
        """Cells whose values are kept: those between the two ends of a bracket. Cell 2 i + 1 is point i alone, 2 i what lies
        before it."""
        cells = set()
        for lo, hi in self.pairs:
            cells |= {2 * i for i in range(bisect_left(self.points, lo) + 1, bisect_left(self.points, hi) + 1)}
        return sorted(cells)

    def cell(self, value: Column, first: int = 0, last: int | None = None) -> Column:
        """The cell of a value, by halving the points."""
        last = len(self.points) if last is None else last
        if first == last:
            return F.lit(2 * first)
        mid = (first + last) // 2
        point = F.lit(self.points[mid])
        return F.when(value < point, self.cell(value, first, mid)).when(value == point, 2 * mid + 1).when(
            value.isNotNull(), self.cell(value, mid + 1, last)
        )


def _first_scan(df: DataFrame, columns: list[str], probs: list[float], stats: dict[str, Callable[[Column], Column]]):
    """One row: per column its count, ends, the sketch at both sides of every share, and the asked-for aggregates."""
    at = [min(1.0, max(0.0, p + d)) for p in probs for d in (-2 / ACCURACY, 2 / ACCURACY, -WIDE, WIDE)]
    out = []
    for i, c in enumerate(columns):
        x = number(df, c)
        out += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        out.append(F.percentile_approx(x, at, ACCURACY).alias(f"at{i}"))
        out += [fn(x).alias(f"{name}{i}") for name, fn in stats.items()]
    return df.agg(*out).first()


def _bracket(row, i: int, probs: list[float]) -> _Brackets:
    n, lo, hi, at = row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"at{i}"]
    ranks, pairs = [], []
    for j, p in enumerate(probs):
        if n * 2 / ACCURACY >= 2:
            pair = at[4 * j], at[4 * j + 1]
        elif n * WIDE >= 2:
            pair = at[4 * j + 2], at[4 * j + 3]
        else:
            pair = lo, hi
        for rank in sorted({math.floor(p * (n - 1)), math.ceil(p * (n - 1))}):
            ranks.append(rank)
            pairs.append(pair)
    return _Brackets(ranks, pairs)


def _second_scan(df: DataFrame, columns: list[str], found: dict[int, _Brackets]) -> DataFrame:
    """(c, cell, value, n): rows per column and cell, with the values themselves where the cell is wanted."""
    rows = df.select(*[number(df, columns[i]).alias(f"x{i}") for i in found])
    rows = rows.select("*", *[b.cell(F.col(f"x{i}")).alias(f"cell{i}") for i, b in found.items()])
    each = []
    for i, b in found.items():
        kept = F.when(F.col(f"cell{i}").isin(b.wanted()), F.col(f"x{i}"))
        each.append(F.struct(F.lit(i).alias("c"), F.col(f"cell{i}").alias("cell"), kept.alias("value")))
    long = rows.select(F.inline(F.array(*each))).where("cell is not null")
    return long.groupBy("c", "cell", "value").agg(F.count(F.lit(1)).alias("n"))


def _ranked(kept: DataFrame, wanted: list[tuple[int, int, int]]) -> dict[tuple[int, int, int], float]:
    """Values at ranks inside cells, (c, cell, rank) each. Cells of very many values are cut finer until one task copes."""
    spark = kept.sparkSession
    rows, asked = kept.withColumn("path", F.lit("")), [(c, cell, "", k, k) for c, cell, k in wanted]
    while True:
        ask = spark.createDataFrame(asked, "c int, cell int, path string, k long, rank long")
        keys = ["c", "cell", "path"]
        rows = rows.join(F.broadcast(ask.select(*keys).distinct()), keys, "left_semi")
        sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        if all(r["m"] <= ONE_TASK for r in sizes.collect()):
            break
        finer = rows.join(F.broadcast(sizes), keys)
        fine = F.when(F.col("m") > ONE_TASK, _fine_cell(F.col("value"), F.col("lo"), F.col("hi")))
        rows = finer.withColumn("fine", F.coalesce(fine, F.lit(0))).withColumn("path", F.concat_ws(".", "path", "fine")).drop("m", "lo", "hi")
        cells = rows.groupBy("c", "cell", F.col("path").alias("next"), F.regexp_replace("path", r"\.?[0-9]+$", "").alias("path"), "fine")
        counted = cells.agg(F.sum("n").alias("n"))
        order = Window.partitionBy(*keys).orderBy("fine")
        placed = counted.withColumn("before", F.sum("n").over(order.rowsBetween(_START, 0)) - F.col("n"))
        hit = placed.join(ask, keys).where("k >= before and k < before + n")
        asked = [(r["c"], r["cell"], r["next"], r["k"] - r["before"], r["rank"]) for r in hit.collect()]
        rows = rows.drop("fine")
    placed = rows.withColumn("upto", F.sum("n").over(Window.partitionBy(*keys).orderBy("value").rowsBetween(_START, 0)))
    hit = placed.join(F.broadcast(ask), keys).where("k >= upto - n and k < upto")
    return {(r["c"], r["cell"], r["rank"]): r["value"] for r in hit.collect()}


def measured(
    df: DataFrame, columns: list[str], probs: list[float], stats: dict[str, Callable[[Column], Column]] | None = None
) -> list[dict]:
    """Per column its exact quantiles (``p``: share to value) and aggregates, in two scans of the columns.

    Columns without a value have no quantiles. Runs at once; the answer is as small as the list of columns.
    """
    stats, probs = stats or {}, [float(p) for p in probs]
    row = _first_scan(df, columns, probs, stats)
    brackets = {i: _bracket(row, i, probs) for i in range(len(columns)) if row[f"n{i}"]}
    values: dict[tuple[int, int], float] = {}
    settled: dict[int, dict[float, float]] = {}
    open_ = {}
    for i, b in brackets.items():
        if row[f"lo{i}"] == row[f"hi{i}"]:
            values |= {(i, k): row[f"lo{i}"] for k in b.ranks}
        else:
            open_[i] = b
    if open_:
        with scratch(df.sparkSession):
            kept = save_scratch(_second_scan(df, columns, open_), "brackets")
            counts: dict[int, dict[int, int]] = {i: {} for i in open_}
            for r in kept.groupBy("c", "cell").agg(F.sum("n").alias("n")).collect():
                counts[r["c"]][r["cell"]] = r["n"]
            inside, missed = [], []
            for i, b in open_.items():
                for k in b.ranks:
                    cell, k_in = _cell_of(counts[i], k)
                    if cell % 2:
                        values[i, k] = b.points[cell // 2]
                    elif cell in b.wanted():
                        inside.append((i, cell, k_in, k))
                    else:
                        missed.append(i)
            if inside:
                found = _ranked(kept, sorted({(i, cell, k_in) for i, cell, k_in, _ in inside}))
                values |= {(i, k): found[i, cell, k_in] for i, cell, k_in, k in inside}
        for i in sorted(set(missed)):
            settled[i] = {r["p"]: r["value"] for r in by_cells(df, [columns[i]], probs).collect()}
    out = []
    for i, c in enumerate(columns):
        n = row[f"n{i}"]
        own = settled.get(i) or ({p: _mixed(values, i, p * (n - 1)) for p in probs} if n else {})
        out.append({"column": c, "p": own, **{name: row[f"{name}{i}"] for name in stats}})
    return out


def _cell_of(counts: dict[int, int], rank: int) -> tuple[int, int]:
    """The cell that holds a rank, and the rank in it."""
    for cell in sorted(counts):
        if rank < counts[cell]:
            return cell, rank
        rank -= counts[cell]
    raise ValueError("rank beyond the last row")


def _mixed(values: dict, i: int, at: float) -> float:
    below, above, part = values[i, math.floor(at)], values[i, math.ceil(at)], at - math.floor(at)
    return below if below == above or part == 0 else below * (1 - part) + above * part


# ---------------------------------------------------------------- groups: cells


def _coarse_cell(value: Column) -> Column:
    """Monotone cell number; at most 1.5 million over all doubles, about 0.1 % wide each. Each infinity has a cell
    of its own, so it is never split further."""
    scaled = F.signum(value) * F.log1p(F.abs(value)) * _COARSE
    return F.floor(F.greatest(F.least(scaled, F.lit(1e6)), F.lit(-1e6))).cast("int")


def _fine_cell(value: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.floor((value - lo) / (hi - lo) * _FINE), F.lit(_FINE - 1)).cast("int")


def _count(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )


def _locate(cells: DataFrame, wanted: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Follow each wanted rank ``k`` of a group into the one of its cells that holds it."""
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(_START, -1)), F.lit(0))
    picked = cells.withColumn("before", before).join(wanted, keys).where("k >= before and k < before + n")
    return picked.withColumn("k", F.col("k") - F.col("before")).drop("before", "n")


def _wanted_ranks(cells: DataFrame, group: list[str], probs: list[float]) -> DataFrame:
    """Coarse cells holding the ranks next to each position p * (n - 1), with the rank inside the cell."""
    whole = Window.partitionBy(*group)
    counted = cells.withColumns(
        {
            "total": F.sum("n").over(whole),
            "before": F.coalesce(F.sum("n").over(whole.orderBy("cell").rowsBetween(_START, -1)), F.lit(0)),
        }
    )
    ranks = []
    for p in probs:
        at = F.lit(float(p)) * (F.col("total") - 1)
        for side, rank in ((0, F.floor(at)), (1, F.ceil(at))):
            ranks.append(
                F.struct(
                    F.lit(float(p)).alias("p"),
                    F.lit(side).alias("side"),
                    rank.cast("bigint").alias("rank"),
                    (at - F.floor(at)).alias("part"),
                )
            )
    inside = F.filter(
        F.array(*ranks), lambda x: (x["rank"] >= F.col("before")) & (x["rank"] < F.col("before") + F.col("n"))
    )
    return counted.withColumn("t", F.explode(inside)).select(
        *group, "cell", "lo", "hi", "t.p", "t.side", "t.part", (F.col("t.rank") - F.col("before")).alias("k")
    )


def celled(df: DataFrame, columns: list[str], by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Long rows with their coarse cells, and the written count and ends of every cell of a group."""
    rows = melt(df, columns, by).withColumn("cell", _coarse_cell(F.col("value")))
    return rows, save_scratch(_count(rows, [*by, "column", "cell"]), "cells")


def by_cells(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None, cells: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Linearly interpolated quantiles: (by ..., column, p, value), from cells (those of ``celled``, if given).

    Runs at once, in one to three passes over the columns; a pass is skipped once every wanted rank
    lies in a cell of equal values.
    """
    by = by or []
    group = [*by, "column"]
    tag = ["p", "side", "part"]
    with scratch(df.sparkSession) as scope:
        rows, counted = cells or celled(df, columns, by)
        first = save_scratch(_wanted_ranks(counted, group, probs), "quantile-cells")
        found = first.where("lo = hi").select(*group, *tag, F.col("lo").alias("value"))
        still = first.where("lo <> hi")
        if not still.isEmpty():
            keys = [*group, "cell"]
            finer = (
                _meet(rows, still.select(*keys, "lo", "hi").distinct(), keys)
                .withColumn("fine", _fine_cell(F.col("value"), F.col("lo"), F.col("hi")))
                .drop("lo", "hi")
            )
            second = _locate(_count(finer, [*keys, "fine"]), still.select(*keys, *tag, "k"), keys, "fine")
            second = save_scratch(second.select(*keys, "fine", "lo", "hi", *tag, "k"), "quantile-cells")
            found = found.unionByName(second.where("lo = hi").select(*group, *tag, F.col("lo").alias("value")))
            still = second.where("lo <> hi")
            if not still.isEmpty():
                keys = [*keys, "fine"]
                last = _meet(finer, still.select(*keys).distinct(), keys)
                values = last.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
                third = _locate(values, still.select(*keys, *tag, "k"), keys, "value")
                found = found.unionByName(save_scratch(third.select(*group, *tag, "value"), "quantile-cells"))
        settled = (
            found.groupBy(*group, "p")
            .agg(
                F.max("part").alias("part"),
                F.max(F.when(F.col("side") == 0, F.col("value"))).alias("below"),
                F.max(F.when(F.col("side") == 1, F.col("value"))).alias("above"),
            )
            .select(*group, "p", _between(F.col("below"), F.col("above"), F.col("part")).alias("value"))
        )
        return scope.keep(save_scratch(settled, "quantiles"))


def _between(below: Column, above: Column, part: Column) -> Column:
    """The value ``part`` of the way up; an infinite end is not mixed in where it has no share."""
    mixed = below * (1 - part) + above * part
    return F.when((below == above) | (part == 0), below).otherwise(mixed)


def _meet(rows: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in the wanted cells. The cells are written, so the planner knows their size, and a join that shuffles may
    split the rows of a hot cell."""
    return rows.join(save_scratch(cells, "quantile-wanted"), keys)


# ---------------------------------------------------------------- both


def exact(df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None) -> DataFrame:
    """Linearly interpolated quantiles: (by ..., column, p, value). Missing values are left out. Runs at once."""
    if by:
        return by_cells(df, columns, probs, by)
    rows = [(m["column"], p, v) for m in measured(df, columns, probs) for p, v in m["p"].items()]
    return df.sparkSession.createDataFrame(rows, "column string, p double, value double")


def exact_wide(
    df: DataFrame,
    columns: list[str],
    named: dict[str, float],
    by: list[str] | None = None,
    cells: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The same with one output column per named quantile: (by ..., column, name ...)."""
    by = by or []
    long = by_cells(df, columns, list(named.values()), by, cells) if by else exact(df, columns, list(named.values()))
    return long.groupBy(*by, "column").agg(
        *[F.max(F.when(F.col("p") == float(p), F.col("value"))).alias(name) for name, p in named.items()]
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
