"""Query of BPE encoding and decoding."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lumbre.llm.tokens import digests
from lumbre.sources.tables import scan

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    """The text of a tokenizer file, read on the driver and sent to the tasks."""
    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text decoded from them."""
    return digests(scan(spark, sf_dir, "documents"), vocabulary()).withColumnRenamed("id", "doc_id")


SQL: dict[str, str] = {}
QUERIES = {"op9_bpe": op9_bpe}
