"""Small helpers the registered cases share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded, as the checks do, so that the order of a sum does not show."""
    names = columns or tuple(f.name for f in df.schema if isinstance(f.dataType, T.DoubleType))
    return df.withColumns({c: F.round(c, digits) for c in names})


def flat(df: DataFrame) -> DataFrame:
    """Array columns as comma-joined text, which every engine prints alike."""
    arrays = {f.name: F.array_join(f.name, ",") for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    return df.withColumns(arrays) if arrays else df


def r(expression: str, digits: int = DIGITS) -> str:
    """The SQL side of ``rounded``."""
    return f"round({expression}, {digits})"


def per_column(columns: list[str], template: str, source: str) -> str:
    """One SELECT per column: ``{c}`` is the column as a double, ``{name}`` its name."""
    return "\nUNION ALL\n".join(
        "SELECT " + template.format(c=f'CAST("{c}" AS DOUBLE)', name=f"'{c}'") + f" FROM {source}" for c in columns
    )
