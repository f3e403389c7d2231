"""Query of the sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.shards import numbered, shard_of
from lumbre.sources.tables import scan

SHARDS = 16


def op6_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and its shard if there were one more."""
    docs = scan(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), [1.0] * SHARDS).alias("shard"),
        shard_of(F.col("doc_id"), [1.0] * (SHARDS + 1)).alias("grown_shard"),
    )
    placed = numbered(docs, "shard", ["doc_id"])
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _best(shards: int) -> str:
    """The shard with the highest rendezvous score, in DuckDB's SQL."""
    u = "(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || s), 1, 12))::BIGINT + 0.5) / 281474976710656.0"
    scores = f"list_transform(range(0, {shards}), lambda s: 1.0 / -ln({u}))"
    return f"CAST(list_position({scores}, list_max({scores})) - 1 AS INTEGER)"


def _crc_table() -> list[int]:
    """CRC-32 of each byte, by the rule of its polynomial."""
    table = list(range(256))
    for _ in range(8):
        table = [(x >> 1) ^ (0xEDB88320 if x & 1 else 0) for x in table]
    return table


SQL = {
    "op6_rendezvous": f"""
WITH bytes AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
sums AS (
  SELECT doc_id, len(b) + 1 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, b),
             lambda c, x: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, x) & 255) + 1])), 4294967295) AS text_crc32,
         {_best(SHARDS)} AS shard, {_best(SHARDS + 1)} AS grown_shard
  FROM bytes)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM sums"""
}
QUERIES = {"op6_rendezvous": op6_rendezvous}
