"""The academy's six declared tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lumbre.operators.audit import ForeignKey, Table
from lumbre.session import prepare

_INT, _TEXT, _DATE, _BOOL, _MONEY = (
    T.IntegerType(),
    T.StringType(),
    T.DateType(),
    T.BooleanType(),
    T.DecimalType(10, 2),
)

STAFF = Table(
    "staff",
    {
        "staff_id": _INT,
        "name": _TEXT,
        "email": _TEXT,
        "address": _TEXT,
        "incorporation_date": _DATE,
        "salary_scale": _INT,
        "job_title": _TEXT,
        "module_id": _INT,
    },
    ("staff_id",),
    ("email",),
    {"name": 255, "email": 255, "address": 255, "job_title": 255},
    (ForeignKey("module_id", "modules", "module_id"),),
)
STUDENTS = Table(
    "students",
    {
        "student_id": _INT,
        "name": _TEXT,
        "email": _TEXT,
        "address": _TEXT,
        "payment": _MONEY,
        "bootcamp_id": _INT,
        "standalone_module_id": _INT,
        "grade_id": _INT,
    },
    ("student_id",),
    ("email",),
    {"name": 255, "email": 255, "address": 255},
    (
        ForeignKey("bootcamp_id", "bootcamps", "bootcamp_id"),
        ForeignKey("standalone_module_id", "modules", "module_id"),
        ForeignKey("grade_id", "grades", "grade_id"),
    ),
)
TEACHERS = Table(
    "teachers",
    {"teacher_id": _INT, "name": _TEXT, "email": _TEXT, "address": _TEXT, "hourly_rate": _MONEY, "module_id": _INT},
    ("teacher_id",),
    ("email",),
    {"name": 255, "email": 255, "address": 255},
    (ForeignKey("module_id", "modules", "module_id"),),
)
GRADES = Table(
    "grades",
    {
        "grade_id": _INT,
        "student_id": _INT,
        "module_id": _INT,
        "teacher_id": _INT,
        "staff_id": _INT,
        "has_attempted_first": _BOOL,
        "has_attempted_second": _BOOL,
        "has_passed": _BOOL,
    },
    ("grade_id",),
    foreign_keys=(
        ForeignKey("student_id", "students", "student_id"),
        ForeignKey("module_id", "modules", "module_id"),
        ForeignKey("teacher_id", "teachers", "teacher_id"),
        ForeignKey("staff_id", "staff", "staff_id"),
    ),
)
BOOTCAMPS = Table(
    "bootcamps",
    {
        "bootcamp_id": _INT,
        "bootcamp_name": _TEXT,
        "bootcamp_edition": _TEXT,
        "tutor_teacher_id": _INT,
        "price": _MONEY,
        "module_id": _INT,
        "staff_admin_id": _INT,
        "student_id": _INT,
    },
    ("bootcamp_id",),
    (),
    {"bootcamp_name": 255, "bootcamp_edition": 10},
    (
        ForeignKey("tutor_teacher_id", "teachers", "teacher_id"),
        ForeignKey("module_id", "modules", "module_id"),
        ForeignKey("staff_admin_id", "staff", "staff_id"),
        ForeignKey("student_id", "students", "student_id"),
    ),
)
MODULES = Table(
    "modules",
    {
        "module_id": _INT,
        "module_name": _TEXT,
        "module_edition": _TEXT,
        "teacher_id": _INT,
        "staff_id": _INT,
        "student_id": _INT,
        "bootcamp_id": _INT,
        "standalone_price": _MONEY,
    },
    ("module_id",),
    (),
    {"module_name": 255, "module_edition": 10},
    (
        ForeignKey("teacher_id", "teachers", "teacher_id"),
        ForeignKey("staff_id", "staff", "staff_id"),
        ForeignKey("student_id", "students", "student_id"),
        ForeignKey("bootcamp_id", "bootcamps", "bootcamp_id"),
    ),
)

#: Foreign keys run in circles (staff and modules point at each other), so audits take all six at once.
ACADEMY = [STAFF, STUDENTS, TEACHERS, GRADES, BOOTCAMPS, MODULES]


def read_declared(spark: SparkSession, spec: Table, path: str) -> DataFrame:
    """Scan a parquet table under its declared schema: nothing is inferred."""
    return prepare(spark).read.schema(spec.schema).parquet(path)
