"""Joins and one-field-per-call operators on hand-made rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lumbre.functions import calls as C
from lumbre.operators import joins
from lumbre.plans import ivr


def test_vdn_aggregation(spark):
    labels = ["ATC", "ATCX", "AT", "TECH", "TEC", "ABSORPTION", "ABSORPTION2", "atc", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "ivr_id int, vdn_label string")
    got = [r[1] for r in ivr.vdn_aggregation(df).orderBy("ivr_id").collect()]
    assert got == ["FRONT", "FRONT", "RESTO", "TECH", "RESTO", "ABSORPTION", "RESTO", "RESTO", "RESTO"]


DOC = "calls_ivr_id long, module_sequece int, step_sequence int, document_type string, document_identification string"


def test_two_document_rules(spark):
    rows = [
        (1, 1, 1, "DNI", "D1"),
        (1, 2, 1, "UNKNOWN", "UNKNOWN"),
        (2, 1, 1, "UNKNOWN", "UNKNOWN"),
        (2, 1, 2, "DESCONOCIDO", "DESCONOCIDO"),
        (3, None, None, None, None),
        (4, 1, 1, "DNI", "OLD"),
        (4, 1, 2, "NIE", "NEW"),
        (4, None, None, "DNI", "NOWHERE"),
    ]
    df = spark.createDataFrame(rows, DOC)
    best = {r["ivr_id"]: (r["document_type"], r["document_identification"]) for r in ivr.document_best_row(df).collect()}
    assert best == {"1": ("DNI", "D1"), "2": ("DESCONOCIDO", "DESCONOCIDO"), "3": (None, None), "4": ("NIE", "NEW")}
    known = {
        r["calls_ivr_id"]: (r["document_type"], r["document_identification"])
        for r in ivr.document_known_row(df).collect()
    }
    nothing = ("DESCONOCIDO", "DESCONOCIDO")
    assert known == {1: ("DNI", "D1"), 2: nothing, 3: nothing, 4: ("NIE", "NEW")}
    assert {r["calls_ivr_id"] for r in ivr.known_documents(df).collect()} == {1, 4}


def test_best_known_text_is_text_maximum(spark):
    rows = [(1, "9"), (1, "10"), (1, "UNKNOWN"), (2, "UNKNOWN"), (2, None), (3, "DESCONOCIDO")]
    df = spark.createDataFrame(rows, "calls_ivr_id long, customer_phone string")
    assert dict(ivr.customer_phone(df).collect()) == {1: "9", 2: "DESCONOCIDO", 3: "DESCONOCIDO"}


def test_clean_integer(spark):
    spark.sql(C.CLEAN_INTEGER_DDL)
    df = spark.createDataFrame([(None,), (0,), (-999999,)], "v long")
    rows = df.select(C.clean_integer(F.col("v")), F.expr("clean_integer(v)")).collect()
    assert [tuple(r) for r in rows] == [(-999999, -999999), (0, 0), (-999999, -999999)]


def test_seconds_are_truncated(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:01.1' a, timestamp'2024-01-01 00:00:00.9' b")
    both = df.select(C.seconds_between(F.col("a"), F.col("b")), C.seconds_between(F.col("b"), F.col("a"))).first()
    assert tuple(both) == (0, 0)


@pytest.mark.parametrize("share,min_rows", [(0.02, 5), (0.001, 1_000_000)])
def test_left_join_with_hot_keys(spark, share, min_rows):
    rng = random.Random(3)
    left = [(k, f"l{k}") for k in [*range(40), None]]
    right = [(rng.choice([1, 1, 1, 2, rng.randrange(60), None]), f"r{i}") for i in range(900)]
    a = spark.createDataFrame(left, "k int, a string")
    b = spark.createDataFrame(right, "k int, b string")
    hot = {r["k"]: r["_parts"] for r in joins.hot_keys(b, ["k"], share, min_rows).collect()}
    assert (set(hot) >= {1, 2}) == (min_rows == 5)
    got = Counter(tuple(r) for r in joins.left_join(a, b, ["k"], True, share, min_rows).select("k", "a", "b").collect())
    matches = {}
    for k, v in right:
        matches.setdefault(k, []).append(v)
    expected = Counter((k, x, y) for k, x in left for y in (matches.get(k) if k is not None else None) or [None])
    assert got == expected


@pytest.mark.parametrize("kind", ["timestamp", "decimal(20,9)", "binary", "date", "double"])
def test_salted_join_is_the_plain_one_for_every_key_type(spark, kind):
    base = F.col("id") % 13
    value = {
        "timestamp": F.timestamp_micros(base * 1_000_000_007 + 123),
        "decimal(20,9)": (base.cast("decimal(20,9)") + F.expr("0.123456789bd")).cast(kind),
        "binary": F.concat(F.lit("\x00é"), base.cast("string")).cast("binary"),
        "date": F.date_add(F.lit("2024-01-01"), base.cast("int")),
        "double": F.when(base == 3, F.lit(-0.0)).otherwise(base / 3),
    }[kind]
    right = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id")).select(value.alias("k"), "id")
    left = spark.range(20).select(value.alias("k"), F.col("id").alias("a")).union(spark.createDataFrame([(None, 99)], right.schema))
    plain = joins.left_join(left, right, ["k"]).select("a", "id").collect()
    salted = joins.left_join(left, right, ["k"], True, 0.02, 5).select("a", "id").collect()
    assert Counter(map(tuple, salted)) == Counter(map(tuple, plain))


def test_detail_keeps_calls_and_modules_without_children(spark):
    calls = spark.createDataFrame([(1,), (2,), (3,)], "ivr_id long")
    for c in ivr.CALL_COLUMNS[1:]:
        calls = calls.withColumn(c, F.lit(None).cast("timestamp" if c.endswith("date") else "string"))
    modules = spark.createDataFrame(
        [(1, 1), (1, 2), (2, None), (9, 1)], "ivr_id long, module_sequece int"
    ).withColumns({c: F.lit("x") for c in ivr.MODULE_COLUMNS[1:]})
    steps = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (2, None, 1), (3, 1, 1)], "ivr_id long, module_sequece int, step_sequence int")
    steps = steps.withColumns({c: F.lit("y") for c in ivr.STEP_COLUMNS[1:]})
    expected = sorted([(1, 1, 1), (1, 1, 2), (1, 2, None), (2, None, None), (3, None, None)], key=str)
    for how in ((), (True,), (True, 0.1, 1)):
        rows = ivr.detail(calls, modules, steps, *how).collect()
        assert sorted(((r["calls_ivr_id"], r["module_sequece"], r["step_sequence"]) for r in rows), key=str) == expected
        assert len(rows[0]) == 25


def test_update_from_rounds_half_to_even(spark):
    df = spark.createDataFrame([("a", 1), ("b", 7), ("c", 9)], "id string, v long")
    new = spark.createDataFrame([("a", 2.5), ("b", 3.5)], "id string, v double")
    assert dict(joins.update_from(df, new, "id", ["v"]).collect()) == {"a": 2, "b": 4, "c": 9}
