"""Runnable cases over the given tables, each with the SQL that checks it where SQL can."""

from lumbre.workloads import audits, calls, entities, learning, pictures, profiles  # noqa: F401
from lumbre.workloads.registry import CASES, ORACLES

__all__ = ["CASES", "ORACLES"]
