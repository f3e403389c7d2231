"""Query of the personal data scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.pii import fit, listed
from lumbre.llm.pii import scan as scan_pii
from lumbre.llm.pii_candidates import KINDS
from lumbre.sources.tables import scan


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = scan(spark, sf_dir, "documents")
    found = scan_pii(docs, fit(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op11_pii": op11_pii}
