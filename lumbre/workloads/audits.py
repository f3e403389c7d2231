"""Registered cases: declared schemas and constraint audits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.operators import audit
from lumbre.session import prepare, scratch_path
from lumbre.sources.academy import ACADEMY, STUDENTS, read_declared
from lumbre.sources.tables import scan
from lumbre.workloads.registry import case
from lumbre.workloads.standins import ivr_calls, ivr_steps, with_tables

#: The six tables as text rows, from given tables; the expressions are SQL that both engines read.
#: Every kind of violation occurs.
TEXT_ROWS: dict[str, tuple[str, dict[str, str]]] = {
    "staff": (
        "supplier",
        {
            "staff_id": "CAST(CASE WHEN s_suppkey % 50 = 7 THEN s_suppkey - 1 ELSE s_suppkey END AS STRING)",
            "name": "s_name",
            "email": "CASE WHEN s_suppkey % 41 = 3 THEN NULL ELSE concat('s', CAST(s_suppkey % 95 AS STRING)) END",
            "address": "CASE WHEN s_suppkey % 30 = 5 THEN repeat('a', 256) ELSE s_name END",
            "incorporation_date": "CASE WHEN s_suppkey % 30 = 1 THEN '2020-13-45' ELSE '2020-01-15' END",
            "salary_scale": "CASE WHEN s_suppkey % 25 = 2 THEN 'high' ELSE CAST(s_nationkey AS STRING) END",
            "job_title": "concat('job ', CAST(s_nationkey AS STRING))",
            "module_id": "CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE CAST(s_suppkey * 31 AS STRING) END",
        },
    ),
    "students": (
        "customer",
        {
            "student_id": "CAST(c_custkey AS STRING)",
            "name": "c_name",
            "email": "CASE WHEN c_custkey % 400 = 9 THEN NULL ELSE concat('c', CAST(c_custkey % 1450 AS STRING)) END",
            "address": "CASE WHEN c_custkey % 700 = 5 THEN repeat('b', 300) ELSE c_mktsegment END",
            "payment": """CASE WHEN c_custkey % 500 = 4 THEN '123456789.00' WHEN c_custkey % 500 = 5 THEN '1.239'
                               ELSE CAST(c_acctbal AS STRING) END""",
            "bootcamp_id": "CAST(c_nationkey + c_custkey % 3 AS STRING)",
            "standalone_module_id": "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(c_custkey * 2 AS STRING) END",
            "grade_id": "CAST(c_custkey * 11 AS STRING)",
        },
    ),
    "teachers": (
        "supplier",
        {
            "teacher_id": "CAST(s_suppkey AS STRING)",
            "name": "s_name",
            "email": "concat('t', CAST(s_suppkey AS STRING))",
            "address": "s_name",
            "hourly_rate": "CASE WHEN s_suppkey % 60 = 9 THEN 'free' ELSE CAST(s_acctbal AS STRING) END",
            "module_id": "CAST(s_suppkey AS STRING)",
        },
    ),
    "grades": (
        "orders",
        {
            "grade_id": "CAST(o_orderkey AS STRING)",
            "student_id": "CASE WHEN o_orderkey % 3 = 0 THEN '-1' ELSE CAST(o_custkey AS STRING) END",
            "module_id": "CAST(o_orderkey % 1999 AS STRING)",
            "teacher_id": "CAST(o_orderkey % 113 AS STRING)",
            "staff_id": "CAST(o_orderkey % 100 AS STRING)",
            "has_attempted_first": "CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END",
            "has_attempted_second": "CASE WHEN o_orderkey % 2000 = 3 THEN 'maybe' ELSE 'false' END",
            "has_passed": "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'true' END",
        },
    ),
    "bootcamps": (
        "nation",
        {
            "bootcamp_id": "CAST(n_nationkey AS STRING)",
            "bootcamp_name": "n_name",
            "bootcamp_edition": "concat('edition ', CAST(n_nationkey AS STRING))",
            "tutor_teacher_id": "CAST(n_nationkey * 7 AS STRING)",
            "price": "CAST(n_nationkey * 100 AS STRING)",
            "module_id": "CAST(n_nationkey AS STRING)",
            "staff_admin_id": "CAST(n_nationkey * 2 AS STRING)",
            "student_id": "CAST(n_nationkey * 1000 AS STRING)",
        },
    ),
    "modules": (
        "part",
        {
            "module_id": "CAST(p_partkey AS STRING)",
            "module_name": "p_name",
            "module_edition": "CASE WHEN p_partkey % 800 = 1 THEN 'eleven char' ELSE CAST(p_size AS STRING) END",
            "teacher_id": "CAST(p_partkey % 120 AS STRING)",
            "staff_id": "CAST(p_partkey % 90 AS STRING)",
            "student_id": "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE CAST(p_partkey AS STRING) END",
            "bootcamp_id": "CAST(p_partkey % 26 AS STRING)",
            "standalone_price": "CAST(p_retailprice AS STRING)",
        },
    ),
}


def text_rows(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        name: scan(spark, folder, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        for name, (source, columns) in TEXT_ROWS.items()
    }


def typed_rows(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The text rows under their declared types; what does not fit is NULL (the type audit lists it)."""
    rows = text_rows(spark, folder)
    return {s.name: rows[s.name].select(*[F.col(c).try_cast(t).alias(c) for c, t in s.columns.items()]) for s in ACADEMY}


def _sql_type(t: T.DataType) -> str:
    return {"int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}.get(
        t.simpleString(), t.simpleString().upper()
    )


TEXT_SQL = {
    name: f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}"
    for name, (source, columns) in TEXT_ROWS.items()
}
TYPED_SQL = {
    s.name: f"SELECT {', '.join(f'TRY_CAST({c} AS {_sql_type(t)}) AS {c}' for c, t in s.columns.items())} "
    f"FROM ({TEXT_SQL[s.name]})"
    for s in ACADEMY
}
TYPED_CTES = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in TYPED_SQL.items())


def _line_sql(table: str, constraint: str, key: str, n: str, rest: str) -> str:
    return f"""SELECT '{table}' AS "table", '{constraint}' AS "constraint", {key} AS key, CAST({n} AS BIGINT) AS n {rest}"""


def _key_sql(table: str, kind: str, *columns: str) -> str:
    shown = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), 'NULL')" for c in columns)
    missing = " OR ".join(f"{c} IS NULL" for c in columns)
    names = ",".join(columns)
    return _line_sql(
        table, f"{kind}({names})", shown, "count(*)", f"FROM {table} GROUP BY {names} HAVING count(*) > 1 OR {missing}"
    )


def _foreign_sql(table: str, column: str, parent: str, key: str) -> str:
    return _line_sql(
        table,
        f"foreign key({column})->{parent}({key})",
        f"CAST({column} AS VARCHAR)",
        "count(*)",
        f"""FROM {table} c WHERE {column} IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{key} = c.{column}) GROUP BY {column}""",
    )


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_LINE_KEY = ("l_orderkey", "l_linenumber")


@case("scan_declared_schema", f"SELECT * REPLACE (CAST(payment AS DOUBLE) AS payment) FROM ({TYPED_SQL['students']})")
def scan_declared_schema(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(prepare(spark), "students")
    typed_rows(spark, folder)["students"].write.mode("overwrite").parquet(path)
    return read_declared(spark, STUDENTS, path).withColumn("payment", F.col("payment").cast("double"))


@case(
    "audit_primary_key",
    f"""{TYPED_CTES}
    {_union([*[_key_sql(s.name, "primary key", *s.primary_key) for s in ACADEMY],
             _key_sql("lineitem", "primary key", *_LINE_KEY)])}""",
)
def audit_primary_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = audit.primary_key(scan(spark, folder, "lineitem"), "lineitem", *_LINE_KEY)
    return audit.audit_primary_keys(typed_rows(spark, folder), ACADEMY).unionByName(lines)


@case(
    "audit_unique_not_null",
    f"""{TYPED_CTES}
    {_union([_key_sql(s.name, "unique not null", c) for s in ACADEMY for c in s.unique_not_null])}""",
)
def audit_unique_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_unique(typed_rows(spark, folder), ACADEMY)


_GIVEN_KEYS = [
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


@case(
    "audit_foreign_key",
    with_tables(
        f"""{TYPED_CTES}
        {_union([*[_foreign_sql(s.name, k.column, k.table, k.key) for s in ACADEMY for k in s.foreign_keys],
                 *[_foreign_sql(*given) for given in _GIVEN_KEYS],
                 _foreign_sql("ivr_steps", "ivr_id", "ivr_calls", "ivr_id")])}""",
        "ivr_calls",
        "ivr_steps",
    ),
)
def audit_foreign_key(spark: SparkSession, folder: str) -> DataFrame:
    keys = [audit.Reference(*given) for given in _GIVEN_KEYS]
    tables = {name: scan(spark, folder, name) for k in keys for name in (k.table, k.parent)}
    tables |= {"ivr_steps": ivr_steps(spark, folder), "ivr_calls": ivr_calls(spark, folder)}
    keys.append(audit.Reference("ivr_steps", "ivr_id", "ivr_calls", "ivr_id"))
    return audit.references({**tables, **typed_rows(spark, folder)}, [*keys, *audit.declared_references(ACADEMY)])


@case(
    "audit_varchar_length",
    "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in TEXT_SQL.items()) + "\n" + _union(
        [
            _line_sql(s.name, f"varchar({n}) {c}", f"CAST(length({c}) AS VARCHAR)", "count(*)",
                      f"FROM {s.name} WHERE length({c}) > {n} GROUP BY length({c})")
            for s in ACADEMY for c, n in s.max_length.items()
        ]
    ),
)
def audit_varchar_length(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_lengths(text_rows(spark, folder), ACADEMY)


def _cast_sql(kinds: tuple[type[T.DataType], ...]) -> str:
    parts = []
    for s in ACADEMY:
        for c, t in s.columns.items():
            if isinstance(t, kinds):
                bad = f"TRY_CAST({c} AS {_sql_type(t)}) IS NULL"
                if isinstance(t, T.DecimalType):
                    bad = f"({bad} OR TRY_CAST({c} AS {_sql_type(t)}) <> TRY_CAST({c} AS DECIMAL(38, 18)))"
                parts.append(
                    _line_sql(s.name, f"{t.simpleString()} {c}", c, "count(*)", f"FROM {s.name} WHERE {c} IS NOT NULL AND {bad} GROUP BY {c}")
                )
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in TEXT_SQL.items()) + "\n" + _union(parts)


@case("audit_decimal_10_2", _cast_sql((T.DecimalType,)))
def audit_decimal_10_2(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_types(text_rows(spark, folder), ACADEMY, T.DecimalType)


@case("audit_types", _cast_sql((T.IntegerType, T.DateType, T.BooleanType)))
def audit_types(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit_types(text_rows(spark, folder), ACADEMY, T.IntegerType, T.DateType, T.BooleanType)
