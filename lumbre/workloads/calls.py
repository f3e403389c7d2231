"""Registered cases of the call workload."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.functions import calls as C
from lumbre.operators import joins
from lumbre.plans import ivr
from lumbre.session import prepare
from lumbre.sources.tables import replace_table, scan
from lumbre.workloads.registry import case
from lumbre.workloads.standins import ivr_calls, ivr_detail, ivr_modules, ivr_steps, with_tables

DETAIL_SQL = with_tables("SELECT * FROM ivr_detail", "ivr_detail")

VDN_CASE = """CASE WHEN left({c}, 3) = 'ATC' THEN 'FRONT' WHEN left({c}, 4) = 'TECH' THEN 'TECH'
                  WHEN {c} = 'ABSORPTION' THEN 'ABSORPTION' ELSE 'RESTO' END"""

_REACH = "epoch_us({a}.calls_start_date) - epoch_us({b}.calls_start_date) BETWEEN 1000000 AND 86400999999"


def _neighbour(later: str, earlier: str) -> str:
    """Whether any other call of the same phone began from one second to a day earlier, in microseconds."""
    return f"""CAST(bool_or(EXISTS (FROM one o WHERE o.calls_phone_number = c.calls_phone_number
      AND o.calls_ivr_id <> c.calls_ivr_id AND c.calls_phone_number <> 'UNKNOWN'
      AND {_REACH.format(a=later, b=earlier)})) AS INTEGER)"""


RECALL_SQL = f"""
SELECT calls_ivr_id, coalesce({_neighbour("c", "o")}, 0) AS "repeated_phone_24H",
       coalesce({_neighbour("o", "c")}, 0) AS "cause_recall_phone_24H"
FROM one c GROUP BY calls_ivr_id"""
ONE = "one AS (SELECT DISTINCT calls_ivr_id, calls_phone_number, calls_start_date FROM ivr_detail)"

#: The document of the greatest (module, step) among those that are known.
LAST_DOCUMENT = """documentation AS (
  SELECT calls_ivr_id, last.document_identification AS document_identification, last.document_type AS document_type
  FROM (SELECT calls_ivr_id,
               arg_max({'document_identification': document_identification, 'document_type': document_type},
                       (module_sequece, step_sequence)) AS last
        FROM ivr_detail WHERE document_identification NOT IN ('UNKNOWN', 'DESCONOCIDO') GROUP BY ALL))"""

SUMMARY_SQL = with_tables(
    f"""WITH {LAST_DOCUMENT},
{ONE},
recall AS ({RECALL_SQL}),
grouped AS (
  SELECT calls_ivr_id, calls_phone_number, calls_ivr_result, {VDN_CASE.format(c="calls_vdn_label")} AS vdn_aggregation,
         calls_start_date, calls_end_date, calls_total_duration, calls_customer_segment, calls_ivr_language,
         calls_steps_module, calls_module_aggregation,
         coalesce(max(nullif(customer_phone, 'UNKNOWN')), 'DESCONOCIDO') AS customer_phone,
         coalesce(max(nullif(billing_account_id, 'UNKNOWN')), 'DESCONOCIDO') AS billing_account_id,
         max(CASE WHEN module_name = 'AVERIA_MASIVA' THEN 1 ELSE 0 END) AS masiva_lg,
         max(CASE WHEN step_name = 'CUSTOMERINFOBYPHONE.TX' AND step_result = 'OK' THEN 1 ELSE 0 END)
           AS info_by_phone_lg,
         max(CASE WHEN step_name = 'CUSTOMERINFOBYDNI.TX' AND step_result = 'OK' THEN 1 ELSE 0 END) AS info_by_dni_lg
  FROM ivr_detail GROUP BY ALL)
SELECT g.calls_ivr_id, g.calls_phone_number, g.calls_ivr_result, g.vdn_aggregation, g.calls_start_date,
       g.calls_end_date, g.calls_total_duration, g.calls_customer_segment, g.calls_ivr_language,
       g.calls_steps_module, g.calls_module_aggregation,
       coalesce(d.document_type, 'DESCONOCIDO') AS document_type,
       coalesce(d.document_identification, 'DESCONOCIDO') AS document_identification,
       g.customer_phone, g.billing_account_id, g.masiva_lg, g.info_by_phone_lg, g.info_by_dni_lg,
       r."repeated_phone_24H", r."cause_recall_phone_24H"
FROM grouped g LEFT JOIN documentation d USING (calls_ivr_id) JOIN recall r USING (calls_ivr_id)""",
    "ivr_detail",
)


# ---------------------------------------------------------------- scans and joins


@case("scan_table", with_tables("SELECT * FROM ivr_calls", "ivr_calls"))
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    ivr_calls(spark, folder).createOrReplaceTempView("ivr_calls")
    return spark.table("ivr_calls")


@case("ivr_detail", DETAIL_SQL)
def detail(spark: SparkSession, folder: str) -> DataFrame:
    return ivr_detail(spark, folder)


def _saved_detail(spark: SparkSession, folder: str, table: str) -> DataFrame:
    with ivr.dealt_by_call(prepare(spark)):
        return replace_table(ivr_detail(spark, folder, steps_first=True, by_call=True), table, "calls_ivr_id", dealt=True)


@case("sink_ctas_detail", DETAIL_SQL)
def sink_ctas_detail(spark: SparkSession, folder: str) -> DataFrame:
    return _saved_detail(spark, folder, "ivr_detail_sink")


@case("sink_ctas_summary", SUMMARY_SQL)
def sink_ctas_summary(spark: SparkSession, folder: str) -> DataFrame:
    # Tables under their names; the summary groups the bucketed detail without a shuffle of it.
    saved = _saved_detail(spark, folder, "ivr_summary_source")
    return replace_table(ivr.summary(saved, ivr_calls(spark, folder)), "ivr_summary_sink", "calls_ivr_id", dealt=True)


@case(
    "project_prefix",
    with_tables(
        """SELECT ivr_id AS calls_ivr_id, phone_number AS calls_phone_number, ivr_result AS calls_ivr_result,
                  vdn_label AS calls_vdn_label, start_date AS calls_start_date,
                  strftime(start_date, '%Y%m%d') AS calls_start_date_id, end_date AS calls_end_date,
                  strftime(end_date, '%Y%m%d') AS calls_end_date_id, total_duration AS calls_total_duration,
                  customer_segment AS calls_customer_segment, ivr_language AS calls_ivr_language,
                  steps_module AS calls_steps_module, module_aggregation AS calls_module_aggregation
           FROM ivr_calls""",
        "ivr_calls",
    ),
)
def project_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.prefix_calls(ivr_calls(spark, folder))


@case(
    "join_left_equi",
    with_tables(
        """SELECT c.ivr_id, c.ivr_result, m.module_sequece, m.module_name, m.module_duration
           FROM ivr_calls c LEFT JOIN ivr_modules m ON c.ivr_id = m.ivr_id""",
        "ivr_calls",
        "ivr_modules",
    ),
)
def join_left_equi(spark: SparkSession, folder: str) -> DataFrame:
    calls = ivr_calls(spark, folder).select("ivr_id", "ivr_result")
    modules = ivr_modules(spark, folder).select("ivr_id", "module_sequece", "module_name", "module_duration")
    return joins.left_join(calls, modules, ["ivr_id"])


@case(
    "join_left_composite",
    with_tables(
        """SELECT m.ivr_id, m.module_sequece, m.module_name, s.step_sequence, s.step_name, s.step_result
           FROM ivr_modules m LEFT JOIN ivr_steps s
           ON m.ivr_id = s.ivr_id AND m.module_sequece = s.module_sequece""",
        "ivr_modules",
        "ivr_steps",
    ),
)
def join_left_composite(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["ivr_id", "module_sequece"]
    modules = ivr_modules(spark, folder).select(*keys, "module_name")
    return joins.left_join(modules, ivr_steps(spark, folder).select(*keys, "step_sequence", "step_name", "step_result"), keys)


@case(
    "join_cast_key",
    with_tables(
        f"""WITH {LAST_DOCUMENT}
           SELECT c.calls_ivr_id, c.module_sequece, c.step_sequence, d.document_type, d.document_identification
           FROM ivr_detail c LEFT JOIN documentation d ON CAST(c.calls_ivr_id AS VARCHAR) = CAST(d.calls_ivr_id AS VARCHAR)""",
        "ivr_detail",
    ),
)
def join_cast_key(spark: SparkSession, folder: str) -> DataFrame:
    # The key is one and the same column on both sides, so it is compared without the text cast; the detail is
    # built once, and its documents are spread over the rows of their call.
    return ivr.with_document(ivr_detail(spark, folder)).select(
        "calls_ivr_id", "module_sequece", "step_sequence", "document_type", "document_identification"
    )


@case("join_self_recall", with_tables(f"WITH {ONE}\n{RECALL_SQL}", "ivr_detail"))
def join_self_recall(spark: SparkSession, folder: str) -> DataFrame:
    # Same question as recall_24h, asked of the call table: no pairs of calls are built.
    return ivr.recall_24h(ivr.prefix_calls(ivr_calls(spark, folder)))


# ---------------------------------------------------------------- one field per call


@case(
    "vdn_aggregation",
    with_tables(f"SELECT ivr_id, {VDN_CASE.format(c='vdn_label')} AS vdn_aggregation FROM ivr_calls", "ivr_calls"),
)
def vdn_aggregation(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.vdn_aggregation(ivr_calls(spark, folder))


@case(
    "flag_has_document",
    with_tables(
        """SELECT calls_ivr_id, module_sequece, step_sequence,
                  CASE WHEN document_identification NOT IN ('UNKNOWN', 'DESCONOCIDO') THEN 1 ELSE 0 END
                    AS has_document_lg FROM ivr_detail""",
        "ivr_detail",
    ),
)
def flag_has_document(spark: SparkSession, folder: str) -> DataFrame:
    known = C.document_known(F.col("document_identification"))
    return ivr_detail(spark, folder).select(
        "calls_ivr_id", "module_sequece", "step_sequence", C.flag(known).alias("has_document_lg")
    )


@case(
    "filter_not_in",
    with_tables(
        """SELECT calls_ivr_id, module_sequece, step_sequence, document_identification FROM ivr_detail
           WHERE document_identification NOT IN ('UNKNOWN', 'DESCONOCIDO')""",
        "ivr_detail",
    ),
)
def filter_not_in(spark: SparkSession, folder: str) -> DataFrame:
    return (
        ivr_detail(spark, folder)
        .where(C.document_known(F.col("document_identification")))
        .select("calls_ivr_id", "module_sequece", "step_sequence", "document_identification")
    )


@case(
    "filter_between",
    with_tables("SELECT ivr_id, total_duration FROM ivr_calls WHERE total_duration BETWEEN 1 AND 2*60", "ivr_calls"),
)
def filter_between(spark: SparkSession, folder: str) -> DataFrame:
    calls = ivr_calls(spark, folder).select("ivr_id", "total_duration")
    return calls.where(F.col("total_duration").between(1, 2 * 60))


@case(
    "document_best_row",
    with_tables(
        """SELECT CAST(calls_ivr_id AS VARCHAR) AS ivr_id, best.document_identification, best.document_type
           FROM (SELECT calls_ivr_id,
                        arg_max({'document_identification': document_identification, 'document_type': document_type},
                                (coalesce(document_identification NOT IN ('UNKNOWN', 'DESCONOCIDO'), false),
                                 coalesce(module_sequece, -1), coalesce(step_sequence, -1))) AS best
                 FROM ivr_detail GROUP BY calls_ivr_id)""",
        "ivr_detail",
    ),
)
def document_best_row(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.document_best_row(ivr_detail(spark, folder))


@case(
    "document_known_row",
    with_tables(
        f"""WITH {LAST_DOCUMENT},
           calls AS (SELECT DISTINCT calls_ivr_id FROM ivr_detail)
           SELECT c.calls_ivr_id, coalesce(d.document_type, 'DESCONOCIDO') AS document_type,
                  coalesce(d.document_identification, 'DESCONOCIDO') AS document_identification
           FROM calls c LEFT JOIN documentation d USING (calls_ivr_id)""",
        "ivr_detail",
    ),
)
def document_known_row(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.document_known_row(ivr_detail(spark, folder))


def _best_text_sql(column: str) -> str:
    return with_tables(
        f"""SELECT calls_ivr_id, coalesce(max(nullif({column}, 'UNKNOWN')), 'DESCONOCIDO') AS {column}
            FROM ivr_detail GROUP BY calls_ivr_id""",
        "ivr_detail",
    )


@case("customer_phone", _best_text_sql("customer_phone"))
def customer_phone(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.customer_phone(ivr_detail(spark, folder))


@case("billing_account_id", _best_text_sql("billing_account_id"))
def billing_account_id(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.billing_account_id(ivr_detail(spark, folder))


def _flag_sql(name: str, condition: str) -> str:
    return with_tables(
        f"""SELECT calls_ivr_id, max(CASE WHEN {condition} THEN 1 ELSE 0 END) AS {name}
            FROM ivr_detail GROUP BY calls_ivr_id""",
        "ivr_detail",
    )


@case("masiva_lg", _flag_sql("masiva_lg", "module_name = 'AVERIA_MASIVA'"))
def masiva_lg(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.call_flag(ivr_detail(spark, folder), "masiva_lg")


@case(
    "info_by_phone_lg",
    _flag_sql("info_by_phone_lg", "step_name = 'CUSTOMERINFOBYPHONE.TX' AND step_result = 'OK'"),
)
def info_by_phone_lg(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.call_flag(ivr_detail(spark, folder), "info_by_phone_lg")


@case("info_by_dni_lg", _flag_sql("info_by_dni_lg", "step_name = 'CUSTOMERINFOBYDNI.TX' AND step_result = 'OK'"))
def info_by_dni_lg(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.call_flag(ivr_detail(spark, folder), "info_by_dni_lg")


@case("recall_24h", with_tables(f"WITH {ONE}\n{RECALL_SQL}", "ivr_detail"))
def recall_24h(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.recall_24h(ivr_detail(spark, folder))


@case(
    "groupby_computed_keys",
    with_tables(
        f"""SELECT {VDN_CASE.format(c="calls_vdn_label")} AS vdn_aggregation,
                   coalesce(document_type, 'DESCONOCIDO') AS document_type,
                   coalesce(document_identification, 'DESCONOCIDO') AS document_identification,
                   count(*) AS n, count(DISTINCT calls_ivr_id) AS calls
            FROM ivr_detail GROUP BY 1, 2, 3""",
        "ivr_detail",
    ),
)
def groupby_computed_keys(spark: SparkSession, folder: str) -> DataFrame:
    # Two names here are input columns as well; the keys meant are the computed ones.
    unknown = F.lit(C.NOT_FOUND)
    return (
        ivr_detail(spark, folder)
        .groupBy(
            C.vdn_aggregation(F.col("calls_vdn_label")).alias("vdn_aggregation"),
            F.coalesce("document_type", unknown).alias("document_type"),
            F.coalesce("document_identification", unknown).alias("document_identification"),
        )
        .agg(F.count(F.lit(1)).alias("n"), F.count_distinct("calls_ivr_id").alias("calls"))
    )


@case("ivr_summary", SUMMARY_SQL)
def ivr_summary(spark: SparkSession, folder: str) -> DataFrame:
    return ivr.summary(ivr_detail(spark, folder), ivr_calls(spark, folder))


# ---------------------------------------------------------------- scalar functions


@case(
    "str_left",
    with_tables(
        "SELECT ivr_id, left(vdn_label, 3) AS left_3, left(vdn_label, 4) AS left_4 FROM ivr_calls", "ivr_calls"
    ),
)
def str_left(spark: SparkSession, folder: str) -> DataFrame:
    label = F.col("vdn_label")
    return ivr_calls(spark, folder).select(
        "ivr_id", F.left(label, F.lit(3)).alias("left_3"), F.left(label, F.lit(4)).alias("left_4")
    )


@case(
    "date_format_id",
    with_tables(
        """SELECT ivr_id, strftime(start_date, '%Y%m%d') AS start_date_id, strftime(end_date, '%Y%m%d') AS end_date_id
           FROM ivr_calls""",
        "ivr_calls",
    ),
)
def date_format_id(spark: SparkSession, folder: str) -> DataFrame:
    return ivr_calls(spark, folder).select(
        "ivr_id",
        C.date_id(F.col("start_date")).alias("start_date_id"),
        C.date_id(F.col("end_date")).alias("end_date_id"),
    )


@case(
    "date_diff_seconds",
    "SELECT event_id, date_sub('second', ts, TIMESTAMP '2024-01-15 12:00:00.5') AS seconds_to_mark FROM events",
)
def date_diff_seconds(spark: SparkSession, folder: str) -> DataFrame:
    mark = F.lit("2024-01-15 12:00:00.5").cast("timestamp")
    return scan(spark, folder, "events").select(
        "event_id", C.seconds_between(mark, F.col("ts").cast("timestamp")).alias("seconds_to_mark")
    )


@case("cast_string", with_tables("SELECT ivr_id, CAST(ivr_id AS VARCHAR) AS ivr_text FROM ivr_calls", "ivr_calls"))
def cast_string(spark: SparkSession, folder: str) -> DataFrame:
    return ivr_calls(spark, folder).select("ivr_id", F.col("ivr_id").cast("string").alias("ivr_text"))


@case(
    "null_functions",
    with_tables(
        """SELECT ivr_id, module_sequece, step_sequence, nullif(customer_phone, 'UNKNOWN') AS phone_or_null,
                  coalesce(step_result, 'NONE') AS result_or_none,
                  CASE WHEN customer_phone = 'UNKNOWN' THEN 1 ELSE 0 END AS phone_unknown
           FROM ivr_steps""",
        "ivr_steps",
    ),
)
def null_functions(spark: SparkSession, folder: str) -> DataFrame:
    return ivr_steps(spark, folder).select(
        "ivr_id",
        "module_sequece",
        "step_sequence",
        F.nullif("customer_phone", F.lit(C.UNKNOWN)).alias("phone_or_null"),
        F.ifnull("step_result", F.lit("NONE")).alias("result_or_none"),
        C.flag(F.col("customer_phone") == C.UNKNOWN).alias("phone_unknown"),
    )


@case(
    "clean_integer",
    with_tables(
        """SELECT calls_ivr_id, coalesce(CAST(module_sequece AS BIGINT), -999999) AS module_sequece,
                  max(coalesce(CAST(step_sequence AS BIGINT), -999999)) AS last_step
           FROM ivr_detail GROUP BY 1, 2""",
        "ivr_detail",
    ),
)
def clean_integer(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark).sql(C.CLEAN_INTEGER_DDL)
    return (
        ivr_detail(spark, folder)
        .groupBy("calls_ivr_id", C.clean_integer(F.col("module_sequece")).alias("module_sequece"))
        .agg(F.expr("max(clean_integer(step_sequence))").alias("last_step"))
    )
