"""Quantiles, histograms, metrics and audits on small frames."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.operators import audit, metrics, profile, quantiles
from lumbre.sources.academy import ACADEMY, STAFF


def _values(kind, rng):
    return {
        "uniform": [rng.random() for _ in range(701)],
        "whole": [float(rng.randrange(10001, 10038)) for _ in range(500)],
        "outliers": [rng.choice([1e-9, 1e300, -1e250, 0.0, rng.gauss(0, 1)]) for _ in range(300)],
        "close": [1e6 + rng.random() * 1e-3 for _ in range(400)],
        "one": [4.25],
        "constant": [2.0] * 20,
        "signs": [rng.gauss(0, 100) for _ in range(333)],
    }[kind]


@pytest.mark.parametrize("kind", ["uniform", "whole", "outliers", "close", "one", "constant", "signs"])
def test_quantiles_are_exact(spark, kind):
    values = _values(kind, random.Random(5))
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "x double").repartition(3)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["p"]: r["value"] for r in quantiles.exact(df, ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-300)


def test_quantiles_next_to_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (-inf, -1e308, 0.0, 2.0, 3.0, 1e308, inf)], "x double")
    got = {r["p"]: r["value"] for r in quantiles.exact(df, ["x"], [0.0, 0.05, 1 / 6, 0.5, 0.75, 0.9, 1.0]).collect()}
    assert (got[0.0], got[0.05], got[1 / 6], got[0.5], got[0.9], got[1.0]) == (-inf, -inf, -1e308, 2.0, inf, inf)
    assert got[0.75] == pytest.approx(5e307)


def test_grouped_quantiles(spark):
    rng = random.Random(9)
    rows = [(rng.choice("aaab"), rng.random(), float(rng.randrange(5))) for _ in range(600)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    found = quantiles.exact(df, ["x", "y"], [0.25, 0.5], ["g"]).collect()
    got = {(r["g"], r["column"], r["p"]): r["value"] for r in found}
    for g in "ab":
        for i, c in ((1, "x"), (2, "y")):
            for p in (0.25, 0.5):
                assert got[g, c, p] == pytest.approx(np.quantile([r[i] for r in rows if r[0] == g], p), rel=1e-12)


def test_describe_skips_missing(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, None), (None, 7)], "a double, b int")
    got = {r["column"]: r for r in profile.describe(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["q50"]) == (2, 2.0, 2.0)
    assert got["b"]["std"] == pytest.approx(math.sqrt(2)) and got["b"]["max"] == 7


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in [0, 1, 5, 10, 10]], "x double, c double")
    got = {(r["column"], r["bin"]): r["n"] for r in profile.histogram(df, ["x", "c"], 10).collect()}
    assert len(got) == 20
    assert [got["x", i] for i in range(10)] == [1, 1, 0, 0, 0, 1, 0, 0, 0, 2]
    assert got["c", 5] == 5 and sum(v for (c, _), v in got.items() if c == "c") == 5


def test_counts(spark):
    df = spark.createDataFrame(
        [(1, "a", ["x", "y"], 1.0), (1, "b", ["y", "x"], float("nan")), (2, None, [], 1.0)], "g int, s string, l array<string>, d double"
    )
    assert dict(profile.distinct_per_column(df, ["g", "s", "d"]).collect()) == {"g": 2, "s": 2, "d": 1}
    assert dict(profile.distinct_per_group(df, "g", ["s", "d"]).collect()) == {"s": 2, "d": 1}
    assert profile.distinct_sets(df, "l").first()[0] == 2
    assert dict(profile.value_counts_exploded(df, "l").collect()) == {"x": 2, "y": 2}
    assert tuple(profile.unique_check(df, "g").first()) == (3, 2, False)
    assert profile.frames_equal(df, df.repartition(2)) and not profile.frames_equal(df, df.unionAll(df))
    assert [r["g"] for r in profile.tail(df, "g", 1).collect()] == [2]


def test_quantile_box(spark):
    df = spark.createDataFrame([(float(i), float(i % 10)) for i in range(101)], "x double, y double")
    got = profile.inside_quantiles(df, ["x"], 0.1, 0.9).agg(F.min("x"), F.max("x"), F.count("x")).first()
    assert tuple(got) == (10.0, 90.0, 81)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "t double, p double")
    assert tuple(metrics.regression_metrics(df, "t", "p").first()) == pytest.approx((2 / 3, 2 / 3, 0.75))
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "t double, p double")
    assert metrics.regression_metrics(flat, "t", "p").first()["r2"] == 0.0
    assert metrics.regression_metrics(flat, "t", "t").first()["r2"] == 1.0
    assert metrics.regression_metrics(flat.limit(1), "t", "p").first()["r2"] is None


def test_classification(spark):
    pairs = [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, 2)] * 2 + [(3, 0)]
    df = spark.createDataFrame(pairs, "t int, p int")
    report = {r["label"]: r for r in metrics.classification_report(df, "t", "p").collect()}
    assert set(report) == {"0", "1", "3", "macro avg", "weighted avg"}
    assert (report["0"]["precision"], report["0"]["recall"], report["0"]["support"]) == (0.75, 0.75, 4)
    assert (report["3"]["precision"], report["3"]["recall"], report["3"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 0.5 + 0) / 3)
    assert report["weighted avg"]["recall"] == pytest.approx(5 / 9)
    matrix = {r["label"]: tuple(r)[1:] for r in metrics.confusion_matrix(df, "t", "p").collect()}
    assert matrix == {0: (3, 1, 0), 1: (0, 2, 0), 3: (1, 0, 0)}
    assert metrics.accuracy(df, "t", "p").first()[0] == pytest.approx(500 / 9)


def _staff(spark, rows):
    return spark.createDataFrame(rows, "staff_id int, email string, module_id int")


def test_key_audits(spark):
    staff = _staff(spark, [(1, "a", 1), (1, "b", None), (2, None, 7), (None, "a", 7)])
    modules = spark.createDataFrame([(1,)], "module_id int")
    keys = {(r["key"], r["n"]) for r in audit.primary_key(staff, "staff", "staff_id").collect()}
    assert keys == {("1", 2), ("NULL", 1)}
    assert {(r["key"], r["n"]) for r in audit.unique(staff, "staff", "email").collect()} == {("a", 2), ("NULL", 1)}
    refers = [audit.Reference("staff", "module_id", "modules", "module_id"), audit.Reference("modules", "module_id", "staff", "staff_id")]
    dangling = audit.references({"staff": staff, "modules": modules.union(modules).union(spark.createDataFrame([(8,)], "m int"))}, refers)
    rows = {(r["table"], r["constraint"], r["key"], r["n"]) for r in dangling.collect()}
    assert rows == {("staff", "foreign key(module_id)->modules(module_id)", "7", 2),
                    ("modules", "foreign key(module_id)->staff(staff_id)", "8", 1)}


def test_value_audits(spark):
    df = spark.createDataFrame(
        [("x" * 256, "123456789.00", "7", "2024-02-30"), ("x" * 255, "1.239", "seven", "2024-02-29"), (None, "1.20", None, None)],
        "name string, money string, n string, d string",
    )
    checks = [
        audit.too_long("name", 255),
        audit.not_castable("money", T.DecimalType(10, 2)),
        audit.not_castable("n", T.IntegerType()),
        audit.not_castable("d", T.DateType()),
    ]
    found = audit.bad_values(df, "t", checks)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert {(r["constraint"].split()[-1], r["key"], r["n"]) for r in found.collect()} == {
        ("name", "256", 1), ("money", "123456789.00", 1), ("money", "1.239", 1), ("n", "seven", 1), ("d", "2024-02-30", 1)
    }


def test_declared_schema():
    assert len(ACADEMY) == 6 and sum(len(t.foreign_keys) for t in ACADEMY) == 17
    assert sum(len(t.unique_not_null) for t in ACADEMY) == 3
    assert STAFF.schema["incorporation_date"].dataType == T.DateType()


def test_distinct_per_group_deals_out_repeated_groups_only(spark, monkeypatch):
    rows = [("a", 1, "x"), ("a", 2, "x"), ("a", 2, None), (None, 5, "p"), (None, 6, "q"), (None, 7, "q"), ("b", None, "z"), ("c", 9, None)]
    df = spark.createDataFrame(rows, "k string, n int, t string")
    seen = []
    plain = profile.entities.duplicated
    monkeypatch.setattr(profile.entities, "duplicated", lambda d, keys: seen.append(plain(d, keys).count()) or plain(d, keys))
    assert dict(profile.distinct_per_group(df, "k", ["n", "t"]).collect()) == {"n": 3, "t": 2}
    assert seen == [6]
    assert dict(profile.distinct_per_group(df.where("k in ('b', 'c')"), "k", ["n", "t"]).collect()) == {"n": 1, "t": 1}
    assert dict(profile.distinct_per_group(df.where("k = 'b'"), "k", ["n", "t"]).collect()) == {"n": 0, "t": 1}
    assert dict(profile.distinct_per_group(df.where("false"), "k", ["n", "t"]).collect()) == {"n": None, "t": None}


def test_unique_keys_are_counted_in_small_parts(spark, monkeypatch):
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before, seen = [spark.conf.get(n, None) for n in names], []

    def spied(df, name):
        seen.append([spark.conf.get(n) for n in names])
        return plain(df, name)

    plain = profile.save_scratch
    monkeypatch.setattr(profile, "save_scratch", spied)
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert tuple(profile.unique_check(df, "k").first()) == (3, 2, False)
    assert tuple(profile.unique_check(df.where("false"), "k").first()) == (0, 0, True)
    assert seen == [["8m", "200"]] * 2
    assert [spark.conf.get(n, None) for n in names] == before
