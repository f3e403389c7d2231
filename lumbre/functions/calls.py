"""Column expressions of the call workload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they decide the results):
UNKNOWN = "UNKNOWN"
NOT_FOUND = "DESCONOCIDO"
NO_DOCUMENT = ("UNKNOWN", "DESCONOCIDO")
MASS_OUTAGE = "AVERIA_MASIVA"
STEP_BY_PHONE = "CUSTOMERINFOBYPHONE.TX"
STEP_BY_DNI = "CUSTOMERINFOBYDNI.TX"
STEP_OK = "OK"
MISSING_INTEGER = -999999
DAY_SECONDS = 24 * 60 * 60


def vdn_aggregation(label: Column) -> Column:
    """Routing group of a line label; anything else, NULL included, is RESTO."""
    return (
        F.when(F.left(label, F.lit(3)) == "ATC", "FRONT")
        .when(F.left(label, F.lit(4)) == "TECH", "TECH")
        .when(label == "ABSORPTION", "ABSORPTION")
        .otherwise("RESTO")
    )


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def document_known(document: Column) -> Column:
    """True for a usable document, NULL for a NULL one."""
    return ~document.isin(*NO_DOCUMENT)


def best_known_text(value: Column) -> Column:
    """Aggregate: the greatest value other than UNKNOWN, or DESCONOCIDO."""
    return F.coalesce(F.max(F.nullif(value, F.lit(UNKNOWN))), F.lit(NOT_FOUND))


def any_flag(condition: Column) -> Column:
    """Aggregate: 1 if any row of the group meets the condition."""
    return F.max(flag(condition))


def mass_outage(module_name: Column) -> Column:
    return module_name == MASS_OUTAGE


def step_succeeded(step_name: Column, step_result: Column, step: str) -> Column:
    return (step_name == step) & (step_result == STEP_OK)


def date_id(ts: Column) -> Column:
    """yyyyMMdd text of a timestamp (UTC session)."""
    return F.date_format(ts, "yyyyMMdd")


def seconds_between(later: Column, earlier: Column) -> Column:
    """Whole elapsed seconds of ``later - earlier``, truncated towards zero."""
    return F.timestamp_diff("SECOND", earlier, later)


def clean_integer(value: Column) -> Column:
    """NULL becomes the agreed marker number."""
    return F.coalesce(value, F.lit(MISSING_INTEGER).cast("bigint"))


#: The same as a SQL function for queries written as text.
CLEAN_INTEGER_DDL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION clean_integer(value BIGINT) RETURNS BIGINT "
    f"RETURN ifnull(value, CAST({MISSING_INTEGER} AS BIGINT))"
)
