"""Query of the secret scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.secrets import Markov, fit, listed, samples
from lumbre.llm.secrets import scan as scan_secrets
from lumbre.sources.tables import scan


def secret_model(docs: DataFrame) -> Markov:
    return fit(samples(docs))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    docs = scan(spark, sf_dir, "documents")
    spans = scan_secrets(docs, secret_model(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "added")).alias("spans"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op5_secrets": op5_secrets}
