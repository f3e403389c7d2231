"""Recall flags against the pairwise definition, on boundaries, repeated ids and cut stretches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from split_soon import SPLIT_SOON

from lumbre.operators import ranges
from lumbre.plans import ivr

T0 = dt.datetime(2024, 3, 1, 12, 0, 0)
SCHEMA = "calls_ivr_id long, calls_phone_number string, calls_start_date timestamp"


def pairwise(rows):
    """The definition, literally."""
    out = {}
    for a_id, a_phone, a_start in rows:
        flags = out.setdefault(a_id, [0, 0])
        for b_id, b_phone, b_start in rows:
            if None in (a_phone, b_phone, a_start, b_start) or a_phone == "UNKNOWN" or a_phone != b_phone or a_id == b_id:
                continue
            micros = (a_start - b_start) // dt.timedelta(microseconds=1)
            seconds = abs(micros) // 1_000_000 * (1 if micros >= 0 else -1)
            flags[0] |= 1 <= seconds <= 86400
            flags[1] |= -86400 <= seconds <= -1
    return {k: (int(a), int(b)) for k, (a, b) in out.items()}


def computed(spark, rows):
    df = ivr.recall_24h(spark.createDataFrame(rows, SCHEMA))
    return {r[0]: (r[1], r[2]) for r in df.collect()}


def many_ranges(monkeypatch, per_task):
    monkeypatch.setattr(ranges, "RANGES_PER_TASK", per_task)


def start(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("gap", [0, 0.9, 1, 1.000001, 2, 86399.5, 86400, 86400.9, 86400.999999, 86401, 86402])
def test_gap(spark, gap):
    rows = [(1, "600", start(0.3)), (2, "600", start(0.3 + gap))]
    expected = (0, 1) if 1 <= gap < 86401 else (0, 0)
    got = computed(spark, rows)
    assert got == pairwise(rows)
    assert got[1] == expected and got[2] == expected[::-1]


def test_phones_that_never_match(spark):
    rows = [
        (1, "UNKNOWN", start(0)),
        (2, "UNKNOWN", start(10)),
        (3, None, start(0)),
        (4, None, start(10)),
        (5, "DESCONOCIDO", start(0)),
        (6, "DESCONOCIDO", start(10)),
        (7, "700", start(0)),
        (8, "800", None),
    ]
    got = computed(spark, rows)
    assert got == pairwise(rows)
    assert got[5] == (0, 1) and got[6] == (1, 0) and got[1] == got[3] == got[7] == got[8] == (0, 0)


def test_an_id_does_not_match_itself(spark):
    rows = [(1, "600", start(0)), (1, "600", start(50)), (2, "601", start(0)), (2, "601", start(5)), (3, "601", start(9))]
    got = computed(spark, rows)
    assert got == pairwise(rows)
    assert got[1] == (0, 0) and got[2] == (0, 1) and got[3] == (1, 0)


@pytest.mark.parametrize("seed", range(6))
def test_random_calls(spark, seed, monkeypatch):
    """Few phones, ids with several starts, starts near each other, ranges of a few seconds of a phone."""
    many_ranges(monkeypatch, 1 + 8 * seed)
    rng = random.Random(seed)
    rows = []
    for _ in range(150):
        day = rng.choice([0, 1, 2, 4, 9])
        second = rng.choice([rng.randrange(86400), rng.randrange(30), 86399 - rng.randrange(3)])
        moment = dt.datetime(2024, 3, 1) + dt.timedelta(days=day, seconds=second, microseconds=rng.choice([0, 1, 500000, 999999]))
        repeat = rng.random() < (0.0, 0.2, 0.8)[seed % 3]
        call = rng.randrange(12) if repeat else 1000 + len(rows)
        rows.append((call, rng.choice(["1", "1", "2", "UNKNOWN", None]), moment))
    assert computed(spark, rows) == pairwise(rows)


def test_symmetry_and_row_order(spark):
    rng = random.Random(7)
    rows = [(i, str(rng.randrange(5)), start(rng.randrange(10 * 86400))) for i in range(120)]
    first = computed(spark, rows)
    rng.shuffle(rows)
    assert computed(spark, rows) == first
    assert any(a for a, _ in first.values()) == any(b for _, b in first.values())


def test_summary_flags_belong_to_the_start(spark):
    """An id with two starts has a summary row, with its own flags, for each."""
    rows = [(1, "600", start(0)), (1, "600", start(3 * 86400)), (2, "600", start(100))]
    blank = ["calls_ivr_result", "calls_vdn_label", "calls_customer_segment", "calls_ivr_language",
             "calls_module_aggregation", "module_name", "step_name", "step_result", "document_type",
             "document_identification", "customer_phone", "billing_account_id"]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({c: F.lit(None).cast("string") for c in blank})
    df = df.withColumns({c: F.lit(None).cast("bigint") for c in ("calls_total_duration", "calls_steps_module", "module_sequece", "step_sequence")})
    df = df.withColumn("calls_end_date", F.col("calls_start_date"))
    got = {
        (r["calls_ivr_id"], r["calls_start_date"]): (r["repeated_phone_24H"], r["cause_recall_phone_24H"])
        for r in ivr.summary(df).collect()
    }
    assert got == {(1, start(0)): (0, 1), (1, start(3 * 86400)): (0, 0), (2, start(100)): (1, 0)}


@pytest.mark.parametrize("per_task", [1, 6, 30])
def test_same_id_over_many_ranges(spark, monkeypatch, per_task):
    """Neighbours of another id that lie several ranges away, with ranges of one id only between."""
    many_ranges(monkeypatch, per_task)
    calls = [(1, "600", start(0))] + [(2, "600", start(3 * k + 0.5 * (k % 2))) for k in range(1, 25)] + [(3, "600", start(90))]
    calls += [(4, "601", start(k)) for k in range(20)] + [(5, "602", start(86400 * k / 7)) for k in range(20)] + [(6, "602", start(86400))]
    assert computed(spark, calls) == pairwise(calls)


def test_one_phone_and_one_id_do_not_fill_a_task(spark, conf):
    """A phone of a third of the calls, and an id of a third: ranges are even, and the join of the calls is split."""
    n = 60_000
    kind = F.col("id") % 3
    calls = spark.range(n).select(
        F.when(kind == 0, F.lit(-1)).otherwise(F.col("id")).alias("ivr_id"),
        F.when(kind == 1, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 9000).cast("string"))).alias("phone"),
        (F.lit(1_700_000_000_000_000) + F.col("id") * 1_300_000).alias("u"),
    )
    seconds = ivr._per_second(calls)
    sizes = [r["count"] for r in ranges.ranged(seconds, ["phone", "sec"]).groupBy("part").count().collect()]
    assert len(sizes) >= 32 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    third = F.col("ivr_id") % 3 == 2
    hot_second = calls.withColumns({"u": F.when(third, F.lit(1_700_000_000_000_000)).otherwise(F.col("u")), "phone": F.when(third, "hot").otherwise(F.col("phone"))})
    for key, value in SPLIT_SOON.items():
        conf(f"spark.sql.{key}", value)
    out = ivr.attach_recall(hot_second.withColumn("more", F.sha2(F.col("ivr_id").cast("string"), 256)), hot_second)
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
