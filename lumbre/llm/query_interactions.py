"""Query of the filter interaction audit: five filters on documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.llm.conversations import SPACE
from lumbre.llm.interactions import audit, failures
from lumbre.sources.tables import save_scratch, scan

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_failures(text: Column) -> list[Column]:
    """Too few words, too few different words, too many capitals, marks of markup."""
    words = F.filter(F.split(text, "[ \t\n\x0b\f\r]+"), lambda w: w != "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return [
        n_words < 200,
        100 * F.size(F.array_distinct(words)) < 50 * n_words,
        100 * capitals > 2 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]


def with_failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of every document; a text that a smaller id has as well fails the last filter.

    What a text fails by itself is told row by row. Texts are compared by 128-bit hashes; the first id of each is
    found by a grouping that is combined before its shuffle, and joined by text and id, which copies do not share, so
    neither a text of many copies nor a null id meets in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("id"),
        F.col(part_col).cast("string").alias("part"),
        F.md5(text).alias("same"),
        failures(text_failures(text)).alias("mask"),
    )
    slim = save_scratch(slim, "failures")
    first = slim.where("id is not null").groupBy("same").agg(F.min("id").alias("first"))
    joined = slim.join(first.withColumnRenamed("same", "of"), (F.col("same") == F.col("of")) & (F.col("id") == F.col("first")), "left")
    again = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 1 << 4).otherwise(0)
    return joined.select("id", "part", (F.col("mask") + again).alias("mask"))


def label_flags(labels: DataFrame) -> DataFrame:
    """(label_id, good, toxic): whether any label of an id says so."""

    def any_of(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    known = labels.where("doc_id is not null")
    return known.groupBy(F.col("doc_id").alias("label_id")).agg(any_of("quality").alias("good"), any_of("toxic").alias("toxic"))


def op13_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every filter removes at every step of every order, per source."""
    docs = with_failures(scan(spark, sf_dir, "documents"))
    flags = label_flags(scan(spark, sf_dir, "labels"))
    rows = docs.join(flags, docs["id"] == flags["label_id"], "left")
    return audit(rows, F.col("part"), F.col("mask"), FILTERS, {"good": F.col("good"), "toxic": F.col("toxic")})


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

SQL = {
    "op13_interactions": f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
flags AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY 1),
fails AS (
  SELECT t.*, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         map {{'A': len({_WORDS}) < 200,
              'B': 100 * len(list_distinct({_WORDS})) < 50 * len({_WORDS}),
              'C': 100 * len(regexp_extract_all(text, '[A-Z]')) > 2 * length(text),
              'D': regexp_matches(text, '[#$%&*|]'),
              'E': coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY text), false)}} AS f
  FROM t LEFT JOIN flags ON flags.doc_id = t.doc_id),
groups AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM fails GROUP BY ALL),
orders AS (
  SELECT '' AS filter_order
  UNION ALL SELECT filter_order || letter FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter)
  WHERE strpos(filter_order, letter) = 0),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS own, string_split(substr(filter_order, 1, step - 1), '') AS earlier
  FROM (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders WHERE length(filter_order) = 5)),
taken AS (
  SELECT part, filter_order, step, own, n, good, toxic, f[own] AS failed,
         len(list_filter(earlier, lambda x: x <> '' AND f[x])) > 0 AS gone,
         len(list_filter(map_values(f), lambda x: x)) = 1 AS once
  FROM groups, steps),
counts AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND once THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failed THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failed THEN toxic ELSE 0 END) AS toxic_lost
  FROM taken GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counts"""
}
QUERIES = {"op13_interactions": op13_interactions}
