"""The workload's input tables, derived from the given tables.

Every table exists twice: as a DataFrame and, under the same name, as SQL for the checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbre.functions.engagement import CATEGORIES
from lumbre.functions.sets import to_set
from lumbre.operators import entities
from lumbre.plans import ivr
from lumbre.plans import poi as poi_plan
from lumbre.sources.tables import save_scratch, scan

# ---------------------------------------------------------------- calls


def ivr_calls(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    whole = F.floor("value").cast("bigint")
    label = F.create_map(
        *[
            F.lit(x)
            for x in (
                *("view", "ATC_GENERAL"),
                *("click", "TECH_LINE"),
                *("purchase", "ABSORPTION"),
                *("signup", "NEW_CUSTOMER"),
            )
        ]
    )
    return scan(spark, folder, "events").select(
        F.col("event_id").alias("ivr_id"),
        F.when(F.col("user_id") % 10 == 0, "UNKNOWN").otherwise(F.col("user_id").cast("string")).alias("phone_number"),
        F.col("event_type").alias("ivr_result"),
        F.get(F.array(F.try_element_at(label, F.col("event_type"))), F.lit(0)).alias("vdn_label"),
        ts.alias("start_date"),
        F.timestamp_add("SECOND", whole, ts).alias("end_date"),
        whole.alias("total_duration"),
        F.concat(F.lit("SEG"), (F.col("user_id") % 4).cast("string")).alias("customer_segment"),
        F.get(F.array(F.lit("ES"), F.lit("CA"), F.lit("EN")), (F.col("user_id") % 3).cast("int")).alias("ivr_language"),
        (F.col("event_id") % 7).alias("steps_module"),
        (F.col("event_id") % 5).cast("string").alias("module_aggregation"),
    )


def _by_call(lines: DataFrame, by_call: bool) -> DataFrame:
    """``lines`` with the id of their call, dealt by it if asked for."""
    lines = lines.withColumnRenamed("l_orderkey", "ivr_id")
    return lines.repartition("ivr_id") if by_call else lines


def ivr_modules(spark: SparkSession, folder: str, by_call: bool = False) -> DataFrame:
    outage = (F.col("ivr_id") + F.col("module_sequece")) % 7 == 0
    return (
        _by_call(scan(spark, folder, "lineitem"), by_call)
        .groupBy("ivr_id", F.col("l_linenumber").alias("module_sequece"))
        .agg(
            F.sum("l_quantity").cast("bigint").alias("module_duration"),
            F.max("l_linestatus").alias("module_result"),
        )
        .select(
            "ivr_id",
            "module_sequece",
            F.when(outage, "AVERIA_MASIVA")
            .otherwise(F.concat(F.lit("MODULE_"), F.col("module_sequece").cast("string")))
            .alias("module_name"),
            "module_duration",
            "module_result",
        )
    )


def ivr_steps(spark: SparkSession, folder: str, by_call: bool = False) -> DataFrame:
    # no step belongs to module 7, so that there is a module without steps; its lines go to module 3
    module = F.when(F.col("l_linenumber") == 7, 3).otherwise(F.col("l_linenumber"))
    raw = (
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax"
    )
    order = Window.partitionBy("ivr_id", "module_sequece").orderBy(*raw)
    supplier = F.col("l_suppkey")

    def pick(key: Column, n: int, *values: Column | str | None) -> Column:
        # only the text that is taken is made; keys that are negative or NULL take none
        return F.coalesce(*[F.when(key % n == i, v) for i, v in enumerate(values) if v is not None])

    # Numbered under the names that steps are joined by, before the texts are made: these are not sent, and the rows not twice.
    return (
        _by_call(scan(spark, folder, "lineitem"), by_call)
        .select("ivr_id", module.alias("module_sequece"), *raw, "l_returnflag")
        .withColumn("step_sequence", F.row_number().over(order))
        .select(
            "ivr_id",
            "module_sequece",
            "step_sequence",
            pick(
                F.col("l_partkey"), 3, "CUSTOMERINFOBYPHONE.TX", "CUSTOMERINFOBYDNI.TX", "OTHER.TX"
            ).alias("step_name"),
            F.when(F.col("l_returnflag") == "A", "OK").when(F.col("l_returnflag") == "N", "KO").alias("step_result"),
            F.when(F.col("l_returnflag") == "N", "ERR").alias("step_description_error"),
            pick(supplier, 4, "UNKNOWN", "DESCONOCIDO", None, "DNI").alias("document_type"),
            pick(
                supplier, 4, "UNKNOWN", "DESCONOCIDO", None, F.concat(F.lit("D"), supplier.cast("string"))
            ).alias("document_identification"),
            pick(supplier, 3, "UNKNOWN", F.concat(F.lit("P"), supplier.cast("string")), None).alias("customer_phone"),
            F.when(F.col("l_partkey") % 5 == 0, "UNKNOWN")
            .otherwise(F.concat(F.lit("B"), F.col("l_partkey").cast("string")))
            .alias("billing_account_id"),
        )
    )


def ivr_detail(spark: SparkSession, folder: str, steps_first: bool = False, by_call: bool = False) -> DataFrame:
    """The detail; ``by_call`` deals modules and steps by the id of the call, so that within ``ivr.dealt_by_call`` the
    lines are shuffled and sorted once for the numbering, the sums and both joins."""
    tables = (ivr_calls(spark, folder), ivr_modules(spark, folder, by_call), ivr_steps(spark, folder, by_call))
    return ivr.detail(*tables, steps_first=steps_first)


SQL: dict[str, str] = {}
NEEDS: dict[str, tuple[str, ...]] = {}

SQL["ivr_calls"] = """
SELECT event_id AS ivr_id,
       CASE WHEN user_id % 10 = 0 THEN 'UNKNOWN' ELSE CAST(user_id AS VARCHAR) END AS phone_number,
       event_type AS ivr_result,
       CASE event_type WHEN 'view' THEN 'ATC_GENERAL' WHEN 'click' THEN 'TECH_LINE'
                       WHEN 'purchase' THEN 'ABSORPTION' WHEN 'signup' THEN 'NEW_CUSTOMER' END AS vdn_label,
       ts AS start_date,
       ts + to_seconds(CAST(floor(value) AS BIGINT)) AS end_date,
       CAST(floor(value) AS BIGINT) AS total_duration,
       'SEG' || CAST(user_id % 4 AS VARCHAR) AS customer_segment,
       CASE user_id % 3 WHEN 0 THEN 'ES' WHEN 1 THEN 'CA' ELSE 'EN' END AS ivr_language,
       event_id % 7 AS steps_module,
       CAST(event_id % 5 AS VARCHAR) AS module_aggregation
FROM events"""

SQL["ivr_modules"] = """
SELECT l_orderkey AS ivr_id, l_linenumber AS module_sequece,
       CASE WHEN (l_orderkey + l_linenumber) % 7 = 0 THEN 'AVERIA_MASIVA'
            ELSE 'MODULE_' || CAST(l_linenumber AS VARCHAR) END AS module_name,
       CAST(sum(l_quantity) AS BIGINT) AS module_duration, max(l_linestatus) AS module_result
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

SQL["ivr_steps"] = """
SELECT l_orderkey AS ivr_id, module AS module_sequece,
       CAST(row_number() OVER (PARTITION BY l_orderkey, module
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS INTEGER)
         AS step_sequence,
       CASE l_partkey % 3 WHEN 0 THEN 'CUSTOMERINFOBYPHONE.TX' WHEN 1 THEN 'CUSTOMERINFOBYDNI.TX'
                          ELSE 'OTHER.TX' END AS step_name,
       CASE l_returnflag WHEN 'A' THEN 'OK' WHEN 'N' THEN 'KO' END AS step_result,
       CASE WHEN l_returnflag = 'N' THEN 'ERR' END AS step_description_error,
       CASE l_suppkey % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'DESCONOCIDO' WHEN 3 THEN 'DNI' END AS document_type,
       CASE l_suppkey % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'DESCONOCIDO'
                          WHEN 3 THEN 'D' || CAST(l_suppkey AS VARCHAR) END AS document_identification,
       CASE l_suppkey % 3 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'P' || CAST(l_suppkey AS VARCHAR) END AS customer_phone,
       CASE WHEN l_partkey % 5 = 0 THEN 'UNKNOWN' ELSE 'B' || CAST(l_partkey AS VARCHAR) END AS billing_account_id
FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN 3 ELSE l_linenumber END AS module FROM lineitem)"""

SQL["ivr_detail"] = """
SELECT c.ivr_id AS calls_ivr_id, c.phone_number AS calls_phone_number, c.ivr_result AS calls_ivr_result,
       c.vdn_label AS calls_vdn_label, c.start_date AS calls_start_date,
       strftime(c.start_date, '%Y%m%d') AS calls_start_date_id, c.end_date AS calls_end_date,
       strftime(c.end_date, '%Y%m%d') AS calls_end_date_id, c.total_duration AS calls_total_duration,
       c.customer_segment AS calls_customer_segment, c.ivr_language AS calls_ivr_language,
       c.steps_module AS calls_steps_module, c.module_aggregation AS calls_module_aggregation,
       m.module_sequece, m.module_name, m.module_duration, m.module_result,
       s.step_sequence, s.step_name, s.step_result, s.step_description_error, s.document_type,
       s.document_identification, s.customer_phone, s.billing_account_id
FROM ivr_calls c
LEFT JOIN ivr_modules m ON c.ivr_id = m.ivr_id
LEFT JOIN ivr_steps s ON m.ivr_id = s.ivr_id AND m.module_sequece = s.module_sequece"""
NEEDS["ivr_detail"] = ("ivr_calls", "ivr_modules", "ivr_steps")


def with_tables(body: str, *names: str) -> str:
    """``body`` with the named stand-ins (and what they need) in front of it as CTEs."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in NEEDS.get(name, ()):
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    ctes = ",\n".join(f"{name} AS ({SQL[name].strip()})" for name in order)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ---------------------------------------------------------------- points of interest


def poi_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows, some with repeated ids; ``ord`` is the input order of a part's rows.

    The rows of every tenth part share an id; each other row has one of its own, of part number and order.
    """
    part = F.col("p_partkey")
    order = Window.partitionBy("l_partkey").orderBy(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_discount", "l_tax"
    )
    lines = scan(spark, folder, "lineitem").withColumn("ord", F.row_number().over(order))
    quiet = part % 97 == 0
    own = F.when((part % 10 == 0) | (F.col("ord") == 1), "").otherwise(F.concat(F.lit("-"), F.col("ord").cast("string")))
    return (
        lines.join(scan(spark, folder, "part"), F.col("l_partkey") == part)
        .select(
            F.concat(F.lit("poi-"), part.cast("string"), own).alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("shortDescription"),
            F.when(part % 50 == 1, "[]")
            .otherwise(F.concat(F.lit("['"), F.col("p_brand"), F.lit("', '"), F.col("p_type"), F.lit("']")))
            .alias("categories"),
            F.concat(F.lit("['"), F.col("l_returnflag"), F.lit("']")).alias("tags"),
            F.concat(F.lit("img/"), part.cast("string"), own, F.lit(".png")).alias("main_image_path"),
            (1 + F.col("p_size") % 4).alias("tier"),
            (-3.7 + (part * 37 % 1000) / 1000).alias("locationLon"),
            (40.4 + (part * 53 % 1000) / 1000).alias("locationLat"),
            (50 * (F.col("p_size") % 13)).alias("xps"),
            (10001 + F.col("l_linenumber")).cast("bigint").alias("Visits"),
            F.when(quiet, 0).otherwise(F.floor(F.col("l_quantity") * 100)).cast("bigint").alias("Likes"),
            F.when(quiet, 0).otherwise(F.round(F.col("l_discount") * 50000)).cast("bigint").alias("Dislikes"),
            F.round(F.col("l_tax") * 25000).cast("bigint").alias("Bookmarks"),
            "ord",
        )
    )


def poi_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows with their lists read as sets."""
    return entities.parse_sets(poi_raw(spark, folder), "categories", "tags")


def poi(spark: SparkSession, folder: str) -> DataFrame:
    return poi_plan.clean(poi_raw(spark, folder))


def poi_stage(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned table saved, as one stage hands it to the next; for work in several passes."""
    return save_scratch(poi(spark, folder), "poi-clean")


def poi_engaged_stage(spark: SparkSession, folder: str) -> DataFrame:
    return save_scratch(poi_engaged(spark, folder), "poi-engaged")


def themed(df: DataFrame) -> DataFrame:
    """Categories renamed to the twelve fixed theme names."""
    names = F.array(*[F.lit(c) for c in CATEGORIES])
    theme = F.transform("categories", lambda c: F.get(names, (F.ascii(F.right(c, F.lit(1))) % 12).cast("int")))
    return df.withColumn("categories", to_set(theme))


def poi_engaged(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned, themed, with counts, signals, score, label and one column per theme."""
    return poi_plan.engage(themed(poi(spark, folder)), list(CATEGORIES))


SQL["poi_rows"] = """
SELECT 'poi-' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 10 = 0 OR ord = 1 THEN '' ELSE '-' || ord END AS id, p_name AS name, p_type AS "shortDescription",
       CASE WHEN p_partkey % 50 = 1 THEN CAST([] AS VARCHAR[]) ELSE list_sort([p_brand, p_type]) END AS categories,
       [l_returnflag] AS tags,
       'img/' || CAST(p_partkey AS VARCHAR) || CASE WHEN p_partkey % 10 = 0 OR ord = 1 THEN '' ELSE '-' || ord END
         || '.png' AS main_image_path,
       1 + p_size % 4 AS tier,
       CAST(-3.7 AS DOUBLE) + CAST(p_partkey * 37 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS "locationLon",
       CAST(40.4 AS DOUBLE) + CAST(p_partkey * 53 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS "locationLat",
       50 * (p_size % 13) AS xps,
       CAST(10001 + l_linenumber AS BIGINT) AS "Visits",
       CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE floor(l_quantity * 100) END AS BIGINT) AS "Likes",
       CAST(CASE WHEN p_partkey % 97 = 0 THEN 0 ELSE round(l_discount * 50000) END AS BIGINT) AS "Dislikes",
       CAST(round(l_tax * 25000) AS BIGINT) AS "Bookmarks",
       CAST(ord AS INTEGER) AS ord
FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey,
             l_extendedprice, l_shipdate, l_quantity, l_discount, l_tax) AS ord FROM lineitem) l
JOIN part ON l_partkey = p_partkey"""

SQL["poi"] = """
SELECT id, arg_min(name, ord) AS name, arg_min("shortDescription", ord) AS "shortDescription",
       arg_min(categories, ord) AS categories,
       list_sort(list_distinct(flatten(list(tags)))) AS tags,
       arg_min(main_image_path, ord) AS main_image_path, arg_min(tier, ord) AS tier,
       arg_min("locationLon", ord) AS "locationLon", arg_min("locationLat", ord) AS "locationLat",
       arg_min(xps, ord) AS xps,
       CAST(round_even(avg("Visits"), 0) AS BIGINT) AS "Visits", CAST(round_even(avg("Likes"), 0) AS BIGINT) AS "Likes",
       CAST(round_even(avg("Dislikes"), 0) AS BIGINT) AS "Dislikes",
       CAST(round_even(avg("Bookmarks"), 0) AS BIGINT) AS "Bookmarks"
FROM poi_rows GROUP BY id"""
NEEDS["poi"] = ("poi_rows",)

_THEMES = "[" + ", ".join(f"'{c}'" for c in CATEGORIES) + "]"
SQL["poi_engaged"] = f"""
SELECT *, CAST(len(categories) AS INTEGER) AS categories_count, CAST(len(tags) AS INTEGER) AS tags_count,
       0.35::DOUBLE * "C" + 0.45::DOUBLE * "S" + 0.20::DOUBLE * "V" AS "E",
       CASE WHEN "S" >= 0.5 AND "C" < 0.2 THEN -1 WHEN "S" < 0.5 AND "C" < 0.2 THEN 0
            WHEN "S" < 0.5 AND "C" >= 0.2 THEN 1 ELSE 2 END AS engagement_label,
       {", ".join(f"CAST(list_contains(categories, '{c}') AS INTEGER) AS " + '"' + c + '"' for c in CATEGORIES)}
FROM (SELECT * REPLACE (list_sort(list_distinct(
               [({_THEMES})[1 + ascii(right(c, 1)) % 12] FOR c IN categories])) AS categories),
             CASE WHEN "Likes" + "Dislikes" > 0
                  THEN CAST("Bookmarks" AS DOUBLE) / CAST("Likes" + "Dislikes" AS DOUBLE) END AS "C",
             CASE WHEN "Likes" + "Dislikes" > 0
                  THEN CAST("Likes" AS DOUBLE) / CAST("Likes" + "Dislikes" AS DOUBLE) END AS "S",
             2 * (1 / (1 + exp(-0.0002::DOUBLE * ("Bookmarks" + "Likes" + "Dislikes")))) - 1 AS "V"
      FROM poi)"""
NEEDS["poi_engaged"] = ("poi",)
