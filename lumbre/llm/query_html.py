"""Query of the HTML extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.html_labeller import extract, fit
from lumbre.sources.tables import scan


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = scan(spark, sf_dir, "pages")
    return extract(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("long"))


SQL: dict[str, str] = {}
QUERIES = {"op10_html": op10_html}
