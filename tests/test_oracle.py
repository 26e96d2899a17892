"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from ledgerline.registry import queries as report_queries  # noqa: E402
from tools.compare import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(report_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(report_queries()) <= set(E.oracle_sql()) & set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert srows, "an empty result tests nothing"
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_renewal_rows_cover_the_cases(spark):
    rows = E.queries()["health_renewal_leads_no_sell_now"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) >= 100
    leads = [r["leadid"] for r in rows]
    assert len(set(leads)) < len(leads)  # duplicate referrals, deals and details
    assert {r["special_deal_flag"] for r in rows} == {0, 1}
    assert {r["Qtr_Locking_Date"] is None for r in rows} == {True, False}  # late bookings
    assert any(r["Accrual_Net_Ins"] == 0 for r in rows)  # PSU insurers


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 10
