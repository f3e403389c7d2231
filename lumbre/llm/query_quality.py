"""Query of the quality classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.quality import Network, fit, score
from lumbre.sources.tables import scan


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels the fit must not see."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def quality_network(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Network:
    """The classifier fitted on the labelled documents that are not held out."""
    labels = scan(spark, sf_dir, "labels").where(~held_out())
    return fit(docs, labels, label_col="quality")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    scored = score(docs, quality_network(spark, docs, sf_dir))
    return scored.select(
        F.col("id").alias("doc_id"),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


SQL: dict[str, str] = {}
QUERIES = {"op1_quality": op1_quality}
