"""Query of the removal of repeated strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.repeats import for_rows, per_text
from lumbre.sources.tables import scan


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of every document repeats, and a digest of the rest."""
    docs = scan(spark, sf_dir, "documents")
    digests = per_text(docs).select(
        "doc", "n", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    rows = for_rows(docs, digests)
    return rows.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


SQL: dict[str, str] = {}
QUERIES = {"op2_repeats": op2_repeats}
