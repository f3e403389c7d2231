"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.decontaminate import contamination, stored_index
from lumbre.sources.tables import scan

#: Consecutive words that make a match.
WORDS = 10


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's words that stand in a window of a benchmark item, and the items found in it."""
    found = contamination(stored_index(scan(spark, sf_dir, "documents")), scan(spark, sf_dir, "benchmark"), n=WORDS)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_LIST = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op8_decontaminate": f"""
WITH d AS (SELECT doc_id, {_LIST} AS w FROM documents),
b AS (SELECT item_id, {_LIST} AS w FROM benchmark),
asked AS (
  SELECT DISTINCT item_id, least({WORDS}, len(w)) AS n,
         array_to_string(list_slice(w, CAST(i AS INT), CAST(i + least({WORDS}, len(w)) - 1 AS INT)), ' ') AS phrase
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WORDS} + 1, 1) + 1)) AS i) WHERE len(w) > 0),
spots AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, CAST(i AS INT), CAST(i + n - 1 AS INT)), ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM asked) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, i, spots.n FROM spots JOIN asked ON spots.n = asked.n AND spots.phrase = asked.phrase),
covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS at FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""
}
QUERIES = {"op8_decontaminate": op8_decontaminate}
