"""Bounded samples for fitting models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those with the lowest hashes of their ids, the same in every run.

    A threshold on the hash lets about twice as many rows through before they are ordered, so that no task gets
    more than a few times ``rows`` however many partitions there are.
    """
    share = 2 * rows / max(1, df.count())
    order = F.xxhash64(F.col(id_col))
    if share < 1:
        df = df.where(order < int((2 * share - 1) * (1 << 63)))
    return df.orderBy(order, F.col(id_col)).limit(rows)
