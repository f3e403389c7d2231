"""Every registered case runs; where SQL can say the same, the rows are the same."""

import pytest

from check import connect, rows_of
from lumbre.plans import models
from lumbre.workloads import CASES, ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name, monkeypatch):
    monkeypatch.setattr(models, "TREES", 8)
    df = CASES[name](spark, FOLDER)
    cur = duck.execute(ORACLES[name])
    expected = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert rows_of(df.columns, df.collect()) == expected


#: What no SQL can say, as it comes out of a fit; ``test_models`` holds the fits against plain ones.
FITTED = {"kmeans_clusters", "kmeans_costs", *(f"gbt_regression{v}_metrics" for v in ("", "_vectors")), *(f"gbt_classification{v}_report" for v in ("", "_vectors"))}


def test_every_case_has_its_sql():
    assert set(ORACLES) == set(CASES) - FITTED


def test_summary_agrees_with_single_fields(spark):
    from lumbre.plans import ivr
    from lumbre.workloads.standins import ivr_detail

    detail = ivr_detail(spark, FOLDER).cache()
    summary = {r["calls_ivr_id"]: r for r in ivr.summary(detail).collect()}
    fields = [
        (ivr.customer_phone(detail), ["customer_phone"]),
        (ivr.billing_account_id(detail), ["billing_account_id"]),
        (ivr.document_known_row(detail), ["document_type", "document_identification"]),
        (ivr.recall_24h(detail), ["repeated_phone_24H", "cause_recall_phone_24H"]),
        *[(ivr.call_flag(detail, n), [n]) for n in ("masiva_lg", "info_by_phone_lg", "info_by_dni_lg")],
    ]
    for df, names in fields:
        rows = df.collect()
        assert len(rows) == len(summary)
        for row in rows:
            for name in names:
                assert row[name] == summary[row["calls_ivr_id"]][name]
    detail.unpersist()
