"""A training corpus from raw documents: five stages, each on all that the one before let through.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and read again for the
next one. All but the last return the columns of the documents. Nulls, empty texts, repeated rows and further
columns are handled as the operators say; an empty table gives an empty result once a classifier is given labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.decontaminate import contamination, stored_index
from lumbre.llm.jaccard import one_of_each
from lumbre.llm.quality import passing
from lumbre.llm.query_bpe import vocabulary
from lumbre.llm.query_quality import quality_network
from lumbre.llm.query_secrets import secret_model
from lumbre.llm.secrets import redacted
from lumbre.llm.tokens import encode
from lumbre.sources.tables import save_scratch, scan, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return passing(docs, quality_network(spark, docs, sf_dir))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    named = docs.select(F.struct("doc_id", F.xxhash64("text").alias("tie")).alias("row"), "text")
    found = contamination(stored_index(named, "row"), scan(spark, sf_dir, "benchmark"))
    hit = found.where("n_hit > 0").select(F.col("id.doc_id").alias("hit_id"), F.col("id.tie").alias("hit_tie")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_tie"])
    return docs.join(hit, same, "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` is that of the masked text."""
    masked = redacted(docs, secret_model(docs))
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The BPE ids of every document."""
    coded = encode(docs, vocabulary())
    return coded.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: SQL can express neither the network nor the chains; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder. What a stage wrote for itself goes when its table is there, and that
    table when the next one is."""
    with scratch(spark) as scope:
        docs = scan(spark, sf_dir, "documents")
        for name, stage in STAGES:
            with scratch(spark) as own:
                done = own.keep(save_scratch(stage(spark, docs, sf_dir), name))
            scope.drop(docs)
            docs = done
        return scope.keep(docs)
