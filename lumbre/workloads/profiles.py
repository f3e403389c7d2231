"""Registered cases: profiles and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.functions import sets
from lumbre.operators import metrics, profile, quantiles
from lumbre.plans import poi as plan
from lumbre.sources.tables import save_scratch, scan
from lumbre.workloads.registry import case
from lumbre.workloads.standins import poi, poi_raw, poi_rows, with_tables
from lumbre.workloads.support import per_column, r, rounded

NUMBERS = ["tier", "xps", "locationLon", "locationLat", *plan.METRICS]

# ---------------------------------------------------------------- counts


@case("row_count", with_tables("SELECT count(*) AS n_rows, 14 AS n_columns FROM poi", "poi"))
def row_count(spark: SparkSession, folder: str) -> DataFrame:
    return profile.row_count(poi(spark, folder))


@case(
    "count_where",
    with_tables(
        """SELECT count(*) FILTER (len(categories) = 0) AS no_categories, count(*) FILTER (len(tags) = 0) AS no_tags,
                  count(*) FILTER ("Bookmarks" > "Likes") AS saved_more FROM poi""",
        "poi",
    ),
)
def count_where(spark: SparkSession, folder: str) -> DataFrame:
    return profile.count_where(
        poi(spark, folder),
        no_categories=sets.size_or_zero(F.col("categories")) == 0,
        no_tags=sets.size_or_zero(F.col("tags")) == 0,
        saved_more=F.col("Bookmarks") > F.col("Likes"),
    )


_LINE_COLUMNS = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@case(
    "profile_columns",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, count({c}) AS non_null FROM lineitem"
        for c, t in _LINE_COLUMNS.items()
    ),
)
def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return profile.column_types(scan(spark, folder, "lineitem"))


@case(
    "distinct_per_column",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM lineitem" for c in _LINE_COLUMNS
    ),
)
def distinct_per_column(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_per_column(scan(spark, folder, "lineitem"), list(_LINE_COLUMNS))


_PER_GROUP = ["name", "shortDescription", "tier", "xps", "main_image_path", "Visits", "Likes"]


@case(
    "distinct_per_group",
    with_tables(
        "\nUNION ALL\n".join(
            f"""SELECT '{c}' AS "column", max(n) AS max_distinct
                FROM (SELECT count(DISTINCT "{c}") AS n FROM poi_rows GROUP BY id)"""
            for c in _PER_GROUP
        ),
        "poi_rows",
    ),
)
def distinct_per_group(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_per_group(poi_rows(spark, folder), "id", _PER_GROUP)


@case(
    "distinct_elements",
    with_tables(
        """SELECT (SELECT count(DISTINCT m) FROM (SELECT unnest(categories) AS m FROM poi)) AS n_categories,
                  (SELECT count(DISTINCT m) FROM (SELECT unnest(tags) AS m FROM poi)) AS n_tags""",
        "poi",
    ),
)
def distinct_elements(spark: SparkSession, folder: str) -> DataFrame:
    rows = save_scratch(poi(spark, folder).select("categories", "tags"), "poi-sets")
    tags = profile.elements(rows, "tags").agg(F.count(F.lit(1)).alias("n"))
    categories = profile.elements(rows, "categories").agg(F.count(F.lit(1)).alias("n_categories"))
    return categories.withColumn("n_tags", tags.scalar())


@case("distinct_sets", with_tables("SELECT count(DISTINCT categories) AS n_sets FROM poi", "poi"))
def distinct_sets(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_sets(poi(spark, folder), "categories")


@case("value_counts", "SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1")
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(scan(spark, folder, "documents"), "source").orderBy(F.desc("n"), "value")


@case(
    "value_counts_exploded",
    with_tables("SELECT value, count(*) AS n FROM (SELECT unnest(categories) AS value FROM poi) GROUP BY 1", "poi"),
)
def value_counts_exploded(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts_exploded(poi(spark, folder), "categories").orderBy(F.desc("n"), "value")


@case("top_k_values", "SELECT p_name AS value, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, value LIMIT 15")
def top_k_values(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(scan(spark, folder, "part"), "p_name", 15)


@case(
    "sort_by_key",
    with_tables("SELECT engagement_label AS value, count(*) AS n FROM poi_engaged GROUP BY 1 ORDER BY 1", "poi_engaged"),
)
def sort_by_key(spark: SparkSession, folder: str) -> DataFrame:
    labels = plan.add_engagement(poi(spark, folder))
    return profile.value_counts(labels, "engagement_label").orderBy("value")


@case(
    "head_tail",
    """SELECT 'head' AS side, * FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5)
       UNION ALL
       SELECT 'tail', * FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey DESC LIMIT 5)""",
)
def head_tail(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    parts = [
        side(rows, "o_orderkey", 5).select(F.lit(name).alias("side"), "*")
        for name, side in (("head", profile.head), ("tail", profile.tail))
    ]
    return parts[0].unionByName(parts[1])


@case(
    "assert_unique",
    with_tables(
        """SELECT count(*) AS n_rows, count(DISTINCT id) AS n_keys, count(*) = count(DISTINCT id) AS is_unique FROM poi""",
        "poi",
    ),
)
def assert_unique(spark: SparkSession, folder: str) -> DataFrame:
    return profile.unique_check(poi(spark, folder), "id")


_ROW = 'id, ord, xps, "Likes"'


@case(
    "frames_equal",
    with_tables(
        f"""WITH repeated AS (SELECT {_ROW} FROM poi_rows WHERE id IN (SELECT id FROM poi_rows GROUP BY id HAVING count(*) > 1)),
              pathed AS (SELECT {_ROW} FROM poi_rows WHERE main_image_path IN
                         (SELECT main_image_path FROM poi_rows GROUP BY 1 HAVING count(*) > 1)),
              busy AS (SELECT {_ROW} FROM pathed WHERE "Likes" > 1000)
            SELECT 'same rows' AS frames, (SELECT count(*) FROM ((FROM repeated EXCEPT ALL FROM pathed) UNION ALL
                                           (FROM pathed EXCEPT ALL FROM repeated))) AS n_different
            UNION ALL SELECT 'some left out', (SELECT count(*) FROM ((FROM repeated EXCEPT ALL FROM busy) UNION ALL
                                               (FROM busy EXCEPT ALL FROM repeated)))""",
        "poi_rows",
    ),
)
def frames_equal(spark: SparkSession, folder: str) -> DataFrame:
    # Rows with a repeated id against rows with a repeated image path (the same rows), and against part of those.
    rows = poi_raw(spark, folder).select("id", "ord", "xps", "Likes", "main_image_path")
    by_id = rows.groupBy("id").count().where("count > 1").select("id")
    by_path = rows.groupBy("main_image_path").count().where("count > 1").select("main_image_path")
    left, right = rows.join(by_id, "id", "left_semi"), rows.join(by_path, "main_image_path", "left_semi")
    found = [
        profile.frames_difference(left.drop("main_image_path"), other.drop("main_image_path"))
        .agg(F.count(F.lit(1)).alias("n_different"))
        .select(F.lit(name).alias("frames"), "n_different")
        for name, other in (("same rows", right), ("some left out", right.where(F.col("Likes") > 1000)))
    ]
    return found[0].unionByName(found[1])


# ---------------------------------------------------------------- distributions

_LENGTHS = ["text", "lang", "source"]


@case(
    "str_length",
    per_column(
        [f"{c}_length" for c in _LENGTHS],
        f"""{{name}} AS "column", count({{c}}) AS "count", {r("avg({c})")} AS mean, {r("stddev_samp({c})")} AS std,
            min({{c}}) AS min, {r("quantile_cont({c}, 0.25)")} AS q25, {r("quantile_cont({c}, 0.5)")} AS q50,
            {r("quantile_cont({c}, 0.75)")} AS q75, max({{c}}) AS max""",
        "(SELECT " + ", ".join(f"length({c}) AS {c}_length" for c in _LENGTHS) + " FROM documents)",
    ),
)
def str_length(spark: SparkSession, folder: str) -> DataFrame:
    lengths = profile.text_lengths(scan(spark, folder, "documents"), _LENGTHS)
    return rounded(profile.describe(lengths, lengths.columns))


_DESCRIBE = f"""{{name}} AS "column", count({{c}}) AS "count", {r("avg({c})")} AS mean, {r("stddev_samp({c})")} AS std,
  {r("min({c})")} AS min, {r("quantile_cont({c}, 0.25)")} AS q25, {r("quantile_cont({c}, 0.5)")} AS q50,
  {r("quantile_cont({c}, 0.75)")} AS q75, {r("max({c})")} AS max"""


@case("describe", with_tables(per_column(NUMBERS, _DESCRIBE, "poi"), "poi"))
def describe(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(save_scratch(poi(spark, folder).select(*NUMBERS), "poi-numbers"), NUMBERS))


_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]
_PRICES = ["l_extendedprice", "l_quantity", "l_discount"]


@case(
    "quantiles",
    "\nUNION ALL\n".join(
        per_column(_PRICES, f"{{name}} AS \"column\", CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont({{c}}, {p})')} AS value", "lineitem")
        for p in _PROBS
    ),
)
def quantiles_case(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.exact(scan(spark, folder, "lineitem"), _PRICES, _PROBS))


@case(
    "mean_std_median",
    per_column(
        _PRICES,
        f"""{{name}} AS "column", {r("avg({c})")} AS mean, {r("stddev_samp({c})")} AS std,
            {r("quantile_cont({c}, 0.5)")} AS median""",
        "lineitem",
    ),
)
def mean_std_median(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.mean_std_median(scan(spark, folder, "lineitem"), _PRICES))


def _histogram_sql(column: str, bins: int, source: str) -> str:
    c = f'CAST("{column}" AS DOUBLE)'
    return f"""SELECT '{column}' AS "column", b AS bin, {r("lo + w * b")} AS lo, {r("lo + w * (b + 1)")} AS hi,
      (SELECT count(*) FROM {source} WHERE least(floor(({c} - e.lo) / (e.hi - e.lo) * {bins}), {bins - 1}) = b) AS n
      FROM (SELECT min({c}) AS lo, max({c}) AS hi, (max({c}) - min({c})) / {bins} AS w FROM {source}) e,
           (SELECT unnest(generate_series(0, {bins - 1})) AS b)"""


@case(
    "histogram_fixed",
    with_tables("\nUNION ALL\n".join(_histogram_sql(c, 40, "poi") for c in ("Likes", "Dislikes", "Bookmarks")), "poi"),
)
def histogram_fixed(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["Likes", "Dislikes", "Bookmarks"]
    return rounded(profile.histogram(save_scratch(poi(spark, folder).select(*columns), "poi-reactions"), columns, 40))


def _box_sql(source: str, by: str, columns: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT g AS "{by}", '{c}' AS "column", count(*) AS n, {r("max(q25)")} AS q25, {r("max(q50)")} AS q50,
               {r("max(q75)")} AS q75,
               {r("min(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))")} AS whisker_lo,
               {r("max(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25))")} AS whisker_hi,
               count(*) FILTER (NOT v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS n_outliers
            FROM (SELECT "{by}" AS g, CAST("{c}" AS DOUBLE) AS v,
                    quantile_cont(CAST("{c}" AS DOUBLE), 0.25) OVER (PARTITION BY "{by}") AS q25,
                    quantile_cont(CAST("{c}" AS DOUBLE), 0.5) OVER (PARTITION BY "{by}") AS q50,
                    quantile_cont(CAST("{c}" AS DOUBLE), 0.75) OVER (PARTITION BY "{by}") AS q75 FROM {source})
            GROUP BY g"""
        for c in columns
    )


@case(
    "box_stats_by_group",
    with_tables(
        f"""WITH exploded AS (SELECT unnest(categories) AS category, "Bookmarks", "Likes", "Dislikes" FROM poi)
            {_box_sql("exploded", "category", ["Bookmarks", "Likes", "Dislikes"])}""",
        "poi",
    ),
)
def box_stats_by_group(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["Bookmarks", "Likes", "Dislikes"]
    saved = save_scratch(poi(spark, folder).select("categories", *columns), "poi-boxes")
    return rounded(profile.box_stats(saved.select(F.explode("categories").alias("category"), *columns), "category", columns))


_PAIRS = [("Visits", "Bookmarks"), ("Visits", "Likes"), ("Visits", "Dislikes"), ("Likes", "Bookmarks")]


@case(
    "correlation",
    with_tables(
        "\nUNION ALL\n".join(
            f"""SELECT '{x}' AS x, '{y}' AS y, {r(f'corr(CAST("{x}" AS DOUBLE), CAST("{y}" AS DOUBLE))')} AS r FROM poi"""
            for x, y in _PAIRS
        ),
        "poi",
    ),
)
def correlation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.correlations(poi(spark, folder), _PAIRS))


# ---------------------------------------------------------------- evaluation


@case(
    "regression_metrics",
    f"""SELECT {r("avg((l_discount - l_tax) * (l_discount - l_tax))")} AS mse,
               {r("avg(abs(l_discount - l_tax))")} AS mae,
               {r("1 - sum((l_discount - l_tax) * (l_discount - l_tax)) / sum((l_discount - m) * (l_discount - m))")} AS r2
        FROM lineitem, (SELECT avg(l_discount) AS m FROM lineitem)""",
)
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.regression_metrics(scan(spark, folder, "lineitem"), "l_discount", "l_tax"))


_FOUR = "(SELECT 2 * quality + toxic AS t, CAST(doc_id % 4 AS INTEGER) AS p FROM labels)"


def _four(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "labels").select(
        (2 * F.col("quality") + F.col("toxic")).alias("t"), (F.col("doc_id") % 4).cast("int").alias("p")
    )


@case("accuracy", f"SELECT {r('100 * avg(CASE WHEN t = p THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM {_FOUR}")
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.accuracy(_four(spark, folder), "t", "p"))


@case(
    "classification_report",
    f"""WITH d AS (SELECT * FROM {_FOUR}),
      c AS (SELECT l, (SELECT count(*) FROM d WHERE t = l) AS support, (SELECT count(*) FROM d WHERE p = l) AS chosen,
                   (SELECT count(*) FROM d WHERE p = l AND t = l) AS hits FROM (SELECT DISTINCT t AS l FROM d)),
      s AS (SELECT l, support, CASE WHEN chosen = 0 THEN 0 ELSE hits / chosen END AS precision, hits / support AS recall FROM c),
      f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM s)
      SELECT CAST(l AS VARCHAR) AS label, {r("precision")} AS precision, {r("recall")} AS recall, {r("f1")} AS f1, support FROM f
      UNION ALL SELECT 'macro avg', {r("avg(precision)")}, {r("avg(recall)")}, {r("avg(f1)")}, CAST(sum(support) AS BIGINT) FROM f
      UNION ALL SELECT 'weighted avg', {r("sum(precision * support) / sum(support)")},
        {r("sum(recall * support) / sum(support)")}, {r("sum(f1 * support) / sum(support)")}, CAST(sum(support) AS BIGINT) FROM f""",
)
def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.classification_report(_four(spark, folder), "t", "p"))


@case(
    "confusion_matrix",
    f"""SELECT t AS label, {", ".join(f"count(*) FILTER (p = {c}) AS predicted_{c}" for c in range(4))}
        FROM {_FOUR} GROUP BY t""",
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(_four(spark, folder), "t", "p")
