"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lumbre.llm.jaccard import jaccard_join
from lumbre.sources.tables import scan


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document, and the number of documents linked to it."""
    return jaccard_join(scan(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL = {
    "op7_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, CAST(i AS INT), CAST(i + 4 AS INT)), ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION ALL SELECT doc_id, CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') ELSE '-' || text END FROM d WHERE len(w) < 5),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY 1),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY ALL HAVING count(*) >= 0.8 * (any_value(na.size) + any_value(nb.size) - count(*)) - 1e-9),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links
FROM (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY 1)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1) USING (doc_id)"""
}
QUERIES = {"op7_jaccard": op7_jaccard}
