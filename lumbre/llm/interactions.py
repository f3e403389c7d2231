"""How filters act on each other: what each removes in every order, by counting paths through the lattice of subsets.

A document fails a set of the filters. Applying filters one by one walks from the empty set up to the full one; a step
from a set to the next is an edge, and what it removes depends on the edge alone: documents that fail the edge's filter
and none of the set before it. Counting forward how many orders reach a set and backward how many lead on from it gives
the number of orders that use an edge, so the Shapley sum of a filter is one weighted sum over its edges, and the steps
of all orders are read from the same edges. Only the counts per set of failed filters are taken from the documents.

Filters are given as Boolean columns; null counts as passed. A null part is the empty one. Repeated rows count each;
further columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Orders are listed one by one, so there may be so many filters at most.
MOST_FILTERS = 7


@dataclass(frozen=True)
class Edge:
    """A step from a set of filters (its bits) by one more, and how many orders come to it and go on after it."""

    state: int
    filter: int
    reach: int
    leave: int


def lattice(n: int) -> list[Edge]:
    """All edges between subsets of ``n`` filters."""
    full = (1 << n) - 1
    reach, leave = [0] * (full + 1), [0] * (full + 1)
    reach[0] = leave[full] = 1
    steps = [(state, f) for state in range(full + 1) for f in range(n) if not state >> f & 1]
    for state, f in steps:
        reach[state | 1 << f] += reach[state]
    for state, f in reversed(steps):
        leave[state] += leave[state | 1 << f]
    return [Edge(state, f, reach[state], leave[state | 1 << f]) for state, f in steps]


def failures(failed: list[Column]) -> Column:
    """Set of failed filters as bits."""
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failed)]
    return sum(bits[1:], bits[0])


def _where(counts: Column, test) -> Column:
    """Sum of those entries of ``counts`` whose place passes a test."""
    return F.aggregate(F.transform(counts, lambda n, at: F.when(test(at), n).otherwise(0)), F.lit(0).cast("bigint"), lambda a, b: a + b)


def _table(rows: list[dict], schema: str) -> Column:
    """A small fixed table as one array literal."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")


def audit(rows: DataFrame, part: Column, mask: Column, names: str, tallies: dict[str, Column]) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    ``names`` gives a letter to each bit of ``mask``. ``tallies`` are 0/1 columns; of each, those lost at a step are
    counted. All documents of a part are summed to one row of counts per set of failed filters, before the shuffle.
    """
    n = len(names)
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters")
    edges = lattice(n)
    places = {(e.state, e.filter): k for k, e in enumerate(edges)}
    kinds = {"all": F.lit(1), **tallies}
    counted = rows.groupBy(F.coalesce(part.cast("string"), F.lit("")).alias("part"), mask.alias("mask")).agg(
        *[F.sum(F.coalesce(c.cast("bigint"), F.lit(0))).alias(f"n_{k}") for k, c in kinds.items()]
    )
    sets = range(1 << n)
    wide = counted.groupBy("part").agg(
        *[F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(f"n_{k}"))), F.lit(0)) for m in sets]).alias(f"n_{k}") for k in kinds]
    )
    known = _table(
        [{"state": e.state, "bit": 1 << e.filter, "filter": e.filter, "weight": e.reach * e.leave} for e in edges],
        "state: bigint, bit: bigint, filter: int, weight: bigint",
    )

    def bits(at: Column, of: Column) -> Column:
        return at.cast("bigint").bitwiseAND(of)

    def removed(kind: str):
        return lambda e: _where(F.col(f"n_{kind}"), lambda at: (bits(at, e["state"]) == 0) & (bits(at, e["bit"]) != 0))

    walked = wide.withColumns({f"removed_{k}": F.transform(known, removed(k)) for k in kinds})
    weighted = F.zip_with(known, F.col("removed_all"), lambda e, r: F.struct(e["filter"].alias("filter"), (e["weight"] * r).alias("sum")))

    def of_filter(f: int) -> dict[str, Column]:
        own = F.filter(weighted, lambda w: w["filter"] == f)
        return {
            "shapley": F.aggregate(own, F.lit(0).cast("bigint"), lambda a, w: a + w["sum"]),
            "failed": _where(F.col("n_all"), lambda at: bits(at, F.lit(1 << f)) != 0),
            "unique": F.col("n_all")[1 << f],
        }

    per_filter = [of_filter(f) for f in range(n)]
    own = {k: [x[k] for x in per_filter] for k in per_filter[0]}
    walked = walked.withColumns({k: F.array(*v) for k, v in own.items()})
    steps = []
    for order in permutations(range(n)):
        state, letters = 0, "".join(names[f] for f in order)
        for step, f in enumerate(order):
            steps.append({"filter_order": letters, "step": step + 1, "edge": places[state, f], "filter": f, "reached": state | 1 << f})
            state |= 1 << f
    steps = _table(steps, "filter_order: string, step: int, edge: int, filter: int, reached: bigint")
    each = walked.withColumn("at", F.explode(steps))
    lost = F.col("removed_all")[F.col("at.edge")]
    return each.select(
        "part",
        "at.filter_order",
        "at.step",
        _where(F.col("n_all"), lambda m: bits(m, F.col("at.reached")) == 0).alias("kept"),
        lost.alias("removed"),
        (F.col("failed")[F.col("at.filter")] - lost).alias("redundant"),
        F.col("unique")[F.col("at.filter")].alias("unique_fails"),
        *[F.col(f"removed_{k}")[F.col("at.edge")].alias(f"{k}_lost") for k in tallies],
        F.col("shapley")[F.col("at.filter")].alias("shapley"),
    )
