"""Where runnable cases and the SQL that checks them are put under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Case = Callable[[SparkSession, str], DataFrame]

CASES: dict[str, Case] = {}
ORACLES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Case], Case]:
    """Register a case; ``sql`` must give the same rows on the same tables."""

    def add(fn: Case) -> Case:
        if name in CASES:
            raise ValueError(f"case {name} registered twice")
        CASES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
