"""Query of the document fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbre.llm.imatch import compared, lexicon
from lumbre.sources.tables import scan


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    docs = scan(spark, sf_dir, "documents")
    return compared(docs, lexicon(docs)).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op3_imatch": op3_imatch}
